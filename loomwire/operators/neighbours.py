"""Approximate k-nearest-neighbour graph by NN-descent (Dong, Charikar and Li, 2011) on DataFrames.

A neighbour of a neighbour is likely a neighbour. Each round, every node lists its current neighbours and a sample of
the nodes that list it (reverse neighbours); all pairs inside one such list are candidates, and every node keeps the
k nearest of its old neighbours and new candidates. The round ends when fewer than ``delta`` * n * k edges changed.

Bounds: a list holds k forward neighbours and reverse ones kept with probability min(1, rho * k / in-degree), so its
expected length is at most (1 + rho) * k whatever the hubs; distances of a list's pairs are computed in one task from
the vectors attached to it (one join), and only pairs go out that are among a node's k nearest of the list and not beyond
its k-th distance so far. The best k of a node's candidates are chosen in two steps over hash slices of
the candidates, so no task holds all candidates of a hub. The start graph comes from random projections: in each of
``tables`` tables a node's bucket is the signs of ``bits`` projections on random directions (less their medians);
one more table puts all nodes in one bucket; buckets are cut by hash into chunks of about ``chunk`` nodes and all
pairs inside a chunk are candidates.

Defined results: rows with a null id, a null or empty vector, or a null or non-finite entry are dropped; of repeated
ids the row with the smallest vector stays; vectors of another length than the most common one are dropped. A node has
min(k, n - 1) neighbours, ranked from 1 by (distance, id). Cosine distance is 1 - cos; zero vectors are at distance 1
from every vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import written


_SLACK = 1e-9  # the same pair's distance may differ by rounding from list to list


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return np.clip(1.0 - a @ b.T, 0.0, 2.0)
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squared, 0.0))


def _projections(batches: Iterator[pd.DataFrame], directions: np.ndarray) -> Iterator[pd.DataFrame]:
    """(id, v, p): the products of each vector with the directions, summed from the first place to the last."""
    for batch in batches:
        if not len(batch):
            continue
        vectors = np.stack(batch["v"].to_numpy())
        p = np.zeros((len(batch), len(directions)))
        for column, weights in zip(vectors.T, directions.T):
            p += column[:, None] * weights
        yield pd.DataFrame({"id": batch["id"], "v": batch["v"], "p": list(p)})


def _start(nodes: DataFrame, dims: int, tables: int, bits: int, chunk: int, seed: int) -> DataFrame:
    """(w, x, vx): chunks of random-projection buckets, as lists for the local join."""
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((tables * bits, dims))
    projected = written(nodes.mapInPandas(lambda it: _projections(it, directions), "id long, v array<double>, p array<double>"))
    medians = projected.agg(*[F.percentile_approx(F.get("p", F.lit(i)), 0.5, 1000).alias(f"p{i}")
                              for i in range(len(directions))]).first()
    found = []
    for t in range(tables):
        signs = [F.when(F.get("p", F.lit(i)) > F.lit(float(medians[f"p{i}"] or 0.0)), 1 << (i - t * bits)).otherwise(0)
                 for i in range(t * bits, (t + 1) * bits)]
        found.append(projected.select("id", "v", F.lit(t).alias("t"), sum(signs[1:], signs[0]).alias("b")))
    # and one table of random chunks, so that every node has candidates however the projections fall
    found.append(projected.select("id", "v", F.lit(tables).alias("t"), F.lit(0).alias("b")))
    buckets = found[0]
    for more in found[1:]:
        buckets = buckets.unionByName(more)
    sizes = buckets.groupBy("t", "b").agg(F.count("*").alias("size"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / chunk))
    cut = buckets.join(sizes, ["t", "b"]).withColumn("c", F.pmod(F.xxhash64("id", F.lit(seed)), parts))
    return cut.select(F.xxhash64("t", "b", "c").alias("w"), F.col("id").alias("x"), F.col("v").alias("vx"))


def _local_join(batches: Iterator[pd.DataFrame], metric: str, k: int) -> Iterator[pd.DataFrame]:
    """The pairs inside each node's list (rows sorted by list owner) that may be among the k nearest, with distances.

    All pairs are computed. For a node the k nearest of its list go out, and of these none beyond ``bound``, its k-th
    distance so far (null: none yet): what is left out has k nearer ones, so it cannot be chosen.
    """
    for batch in batches:
        if not len(batch):
            continue
        owners = batch["w"].to_numpy()
        cuts = np.flatnonzero(np.diff(owners)) + 1
        for group in np.split(np.arange(len(batch)), cuts):
            ids = batch["x"].to_numpy()[group]
            if len(ids) < 2:
                continue
            vectors = np.stack(batch["vx"].to_numpy()[group])
            d = _distances(vectors, vectors, metric)
            usable = ids[:, None] != ids[None, :]
            if "bound" in batch:
                bound = batch["bound"].to_numpy(dtype=float)[group][:, None]
                usable &= ~(d > bound + _SLACK)  # a missing bound passes
            if len(ids) > k + 1:
                usable &= d <= np.partition(np.where(usable, d, np.inf), k - 1, axis=1)[:, k - 1:k] + _SLACK
            i, j = np.nonzero(usable)
            yield pd.DataFrame({"u": ids[i], "v": ids[j], "d": d[i, j]})


def _best(edges: DataFrame, k: int, slices: int = 16) -> DataFrame:
    """The k nearest distinct neighbours of each node, chosen per hash slice first."""
    pairs = edges.groupBy("u", "v").agg(F.min("d").alias("d"))
    pick = lambda c: F.slice(F.array_sort(F.collect_list(F.struct("d", "v"))), 1, k)
    sliced = pairs.groupBy("u", F.pmod(F.xxhash64("v"), F.lit(slices)).alias("s")).agg(pick(None).alias("top"))
    merged = sliced.select("u", F.explode("top").alias("t")).select("u", "t.d", "t.v").groupBy("u").agg(
        pick(None).alias("top"))
    return merged.select("u", F.posexplode("top").alias("r", "t")).select(
        "u", F.col("t.v").alias("v"), F.col("t.d").alias("d"), (F.col("r") + 1).alias("rank"))


def prepared(points: DataFrame, key: str, vector: str, metric: str = "cosine") -> DataFrame:
    """(id, v): cleaned vectors as doubles, unit length for cosine."""
    v = F.col(vector).cast("array<double>")
    ok = points.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    ok = ok.groupBy("id").agg(F.min("v").alias("v"))
    common = ok.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1)
    ok = ok.join(common, F.size("v") == F.col("n"), "left_semi")
    if metric == "cosine":
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))
        ok = ok.select("id", F.transform("v", lambda c: F.when(norm > 0, c / norm).otherwise(F.lit(0.0))).alias("v"))
    return ok


def knn_graph(points: DataFrame, key: str, vector: str, k: int = 15, metric: str = "cosine", rounds: int = 10,
              rho: float = 1.0, delta: float = 0.001, seed: int = 11, tables: int = 8, chunk: int = 64,
              pool: int | None = None) -> DataFrame:
    """(u, v, d, rank): the k nearest neighbours found for every node. Runs Spark jobs while it is built.

    The rounds keep ``pool`` (default 2k) neighbours a node, of which the nearest k are returned.
    """
    final, k = k, pool or 2 * k
    nodes = written(prepared(points, key, vector, metric))
    n = nodes.count()
    if n < 2:
        return nodes.sparkSession.createDataFrame([], "u long, v long, d double, rank int")
    dims = len(nodes.first()["v"])
    bits = max(1, int(np.log2(max(n / chunk, 1))))
    lists = _start(nodes, dims, tables, bits, chunk, seed)
    start = (lists.repartition("w").sortWithinPartitions("w")
             .mapInPandas(lambda it: _local_join(it, metric, k), "u long, v long, d double"))
    graph = written(_best(start, k))
    for step in range(rounds):
        indegree = graph.groupBy(F.col("v").alias("w")).agg(F.count("*").alias("indegree"))
        keep = F.least(F.lit(1.0), F.lit(rho * k) / F.col("indegree"))
        chance = (F.pmod(F.xxhash64("u", "v", F.lit(seed + step)), F.lit(1 << 20)) / float(1 << 20))
        reverse = graph.join(indegree, graph.v == indegree.w).where(chance < keep).select(
            F.col("v").alias("w"), F.col("u").alias("x"))
        lists = graph.select(F.col("u").alias("w"), F.col("v").alias("x")).unionByName(reverse)
        lists = lists.distinct()
        bounds = graph.where(F.col("rank") == k).select(F.col("u").alias("x"), F.col("d").alias("bound"))
        bounded = nodes.select(F.col("id").alias("x"), F.col("v").alias("vx")).join(bounds, "x", "left")
        candidates = (lists.join(bounded, "x").repartition("w").sortWithinPartitions("w")
                      .mapInPandas(lambda it: _local_join(it, metric, k), "u long, v long, d double"))
        fresh = written(_best(candidates.unionByName(graph.select("u", "v", "d")), k))
        changed = fresh.join(graph, ["u", "v"], "left_anti").count()
        graph = fresh
        if changed < delta * n * k:
            break
    return graph.where(F.col("rank") <= final).select("u", "v", "d", F.col("rank").cast("int").alias("rank"))
