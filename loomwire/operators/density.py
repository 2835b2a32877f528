"""Density clustering of low-dimensional points: DBSCAN on a lattice.

Points are snapped to a lattice of side eps / (m * sqrt(k)) for k dimensions, so each moves by at
most eps / (2 m). On the lattice the result is exactly DBSCAN's (a core point has min_pts points
within eps, itself included; core points within eps of each other are one cluster; other points join
the nearest core point within eps), which is the rho-approximate DBSCAN of Gan & Tao (2015).

No step lists all pairs of a group of points:
* Copies and close points are one weighted lattice point, combined before the shuffle.
* Lattice points lie in cells of side eps / sqrt(k), at most m^k of them per cell whatever the data,
  all within eps of each other. A cell with min_pts points is all core without any test.
* Tables of points, cells and pairs are joined in the tasks: none is broadcast through the driver.
* Neighbouring cells are found by equi-joins, two dimensions at a time, along occupied prefixes only.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import in_tasks, written
from .components import connected_components


def lattice_point(coords: Column | str, dims: int, eps: float, fineness: int = 4) -> Column:
    """Integer coordinates of a point on the lattice."""
    side = eps / (fineness * dims ** 0.5)
    coords = F.col(coords) if isinstance(coords, str) else coords
    return F.transform(coords, lambda x: F.floor(x / side).cast("long"))


def _names(prefix: str, dims: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(dims)]


def _distance(a: str, b: str, dims: int) -> Column:
    """Squared distance in lattice units of two points in columns, as plain arithmetic."""
    deltas = [F.col(x) - F.col(y) for x, y in zip(_names(a, dims), _names(b, dims))]
    return sum((d * d for d in deltas[1:]), deltas[0] * deltas[0])


def _nearest(distance: Column, component: Column) -> Column:
    """Distance, then component as one decimal: the minimum of a struct would sort every pair of a task."""
    return (distance.cast("decimal(18,0)") * F.lit(str(1 << 63)).cast("decimal(19,0)") + component.cast("decimal(19,0)")).cast("decimal(38,0)")


def _steps(width: int, dims: int, fineness: int) -> Column:
    """Cell offsets in ``width`` dimensions with the least squared distance which they leave."""
    limit = dims * fineness * fineness
    gap = {o: 0 if o == 0 else ((abs(o) - 1) * fineness + 1) ** 2 for o in range(-dims - 1, dims + 2)}
    found = ((o, sum(gap[x] for x in o)) for o in itertools.product(gap, repeat=width))
    return F.array(*[F.struct(*[F.lit(x).cast("long").alias(f"s{i}") for i, x in enumerate(o)], F.lit(g).alias("gap"))
                     for o, g in found if g <= limit])


def neighbour_cells(cells: DataFrame, dims: int, fineness: int) -> DataFrame:
    """(u, v): numbers of occupied cells which may hold points within eps of each other, self included.

    ``cells`` has (node, c0, c1, ...). After every two dimensions what leads to no occupied cell goes.
    """
    limit = dims * fineness * fineness
    own, near = _names("c", dims), _names("n", dims)
    # few rows here become many: by the key they start from all tasks
    pairs = cells.repartition("node").select(F.col("node").alias("u"), *own, F.lit(0).alias("_gap"))
    for start in range(0, dims, 2):
        width = min(2, dims - start)
        done = near[:start + width]
        pairs = (pairs.withColumn("_step", F.explode(_steps(width, dims, fineness)))
                 .withColumns({near[start + i]: F.col(own[start + i]) + F.col(f"_step.s{i}") for i in range(width)})
                 .withColumn("_gap", F.col("_gap") + F.col("_step.gap")).drop("_step")
                 .where(F.col("_gap") <= limit))
        if start + width < dims:
            occupied = cells.select(*[F.col(c).alias(n) for c, n in zip(own, done)]).distinct()
            pairs = pairs.join(in_tasks(occupied), done, "left_semi")
    target = cells.select(F.col("node").alias("v"), *[F.col(c).alias(n) for c, n in zip(own, near)])
    return pairs.join(in_tasks(target), near).select("u", "v")


def density_clusters(points: DataFrame, coords: str, dims: int, eps: float, min_pts: int = 5,
                     min_cluster_size: int = 5, fineness: int = 4) -> DataFrame:
    """(point, cluster, core) for every occupied lattice point; clusters are numbered by a core cell, and
    what is no cluster or a cluster below ``min_cluster_size`` has none (null); ``core`` marks core points."""
    limit = dims * fineness * fineness
    place, own, far = _names("p", dims), _names("c", dims), _names("q", dims)
    snapped = (points.select(lattice_point(coords, dims, eps, fineness).alias("point"))
               .groupBy("point").agg(F.count(F.lit(1)).alias("weight"))
               .select("weight", *[F.get("point", F.lit(i)).alias(p) for i, p in enumerate(place)]))
    # numbers follow the order of the points, so that equal input gives equal clusters
    numbered = snapped.orderBy(*place).withColumn("pid", F.monotonically_increasing_id()).withColumns(
        {c: F.floor(F.col(p) / fineness).cast("long") for c, p in zip(own, place)})
    in_cell = Window.partitionBy(*own)  # at most fineness^dims rows
    lattice = written(numbered.withColumns({"node": F.min("pid").over(in_cell),
                                            "cell_weight": F.sum("weight").over(in_cell)}))
    cells = lattice.where("node = pid")
    pairs = in_tasks(written(neighbour_cells(cells.select("node", *own), dims, fineness)))
    within = _distance("p", "q", dims) <= limit

    # core points: all of a dense cell; of a sparse cell (fewer than min_pts points) by counting
    is_sparse = F.col("cell_weight") < min_pts
    sparse = lattice.where(is_sparse).select("pid", F.col("node").alias("u"), *place)
    around = lattice.select(F.col("node").alias("v"), F.col("weight").alias("near_weight"),
                            *[F.col(p).alias(q) for p, q in zip(place, far)])
    counted = written(sparse.join(pairs, "u").join(in_tasks(around), "v").where(within)
                      .groupBy("pid", "u", *place).agg(F.sum("near_weight").alias("n")))
    core = lattice.where(~is_sparse).select("pid", "node", *place).unionByName(
        counted.where(F.col("n") >= min_pts).select("pid", F.col("u").alias("node"), *place))

    # cells are joined when any two of their core points are within eps
    near_core = core.select(F.col("node").alias("v"), *[F.col(p).alias(q) for p, q in zip(place, far)])
    edges = (core.withColumnRenamed("node", "u").join(pairs.where("u < v"), "u").join(in_tasks(near_core), "v")
             .where(within).select("u", "v").distinct())
    nodes = core.select("node").distinct()
    components = connected_components(nodes, edges)

    # remaining points of sparse cells go to the nearest core point within eps
    labelled = near_core.join(in_tasks(components.withColumnRenamed("node", "v")), "v")
    attached = (counted.where(F.col("n") < min_pts).join(pairs, "u").join(in_tasks(labelled), "v").where(within)
                .groupBy("pid").agg(F.min(_nearest(_distance("p", "q", dims), F.col("component"))).alias("best"))
                .select("pid", (F.col("best") % F.lit(str(1 << 63)).cast("decimal(19,0)")).cast("long").alias("component")))
    members = core.join(in_tasks(components), "node").select("pid", "component").unionByName(attached)
    cores = core.select("pid", F.lit(True).alias("core"))
    weighted = written(lattice.join(in_tasks(members), "pid", "left").join(in_tasks(cores), "pid", "left").select(
        "weight", "component", F.array(*place).alias("point"), F.coalesce("core", F.lit(False)).alias("core")))
    sizes = (weighted.where(F.col("component").isNotNull()).groupBy("component")
             .agg(F.sum("weight").alias("size")).where(F.col("size") >= min_cluster_size)
             .select("component", F.col("component").alias("cluster")))
    return weighted.join(in_tasks(sizes), "component", "left").select("point", "cluster", "core")
