"""HDBSCAN (excess of mass) on DataFrames: no eps, a hierarchy of density levels instead.

1. Core distances from the k-nearest-neighbour graph (``neighbours.knn_graph``): the distance to the
   (min_samples - 1)-th other point, as HDBSCAN counts the point itself.
2. Mutual reachability max(core u, core v, d) on the graph's edges.
3. Components on a geometric ladder of ``levels`` distances between the least core distance and the largest edge,
   finest first, all in one run of the connected components of ``components.py`` (logarithmic rounds) over a layered
   graph: a node is (level, point) for each level that reaches the point's core distance, an edge joins two nodes of
   one level when their mutual reachability is within the level's distance. A component is named by its least point.
4. The condensed tree: a component of at least ``min_cluster_size`` points continues its parent's cluster when it is
   the parent's only such child, and starts a cluster when there are several; the rest falls out as noise.
   Stability of a cluster is the sum over its levels below its birth of (points) x (lambda step), lambda = 1 / distance.
5. Excess of mass, bottom-up by birth level: a cluster stays when its stability is at least the sum of its
   children's; the root is never chosen (as ``allow_single_cluster=False``). Points get the chosen cluster holding them
   at its birth, others -1.

Nothing lists the pairs of a dense region: candidates are graph edges (k per point); every step is a join or an
aggregate on tables of points, edges, or components, and the loops run over the levels (a parameter), not over data.
Against exact HDBSCAN: distances are rounded up to the ladder, and components are taken on the neighbour graph rather
than the complete graph, so clusters joined only by an edge outside it join at the top (as children of one root).

Defined results: rows with a null id or an unusable vector are dropped (as in ``knn_graph``); repeated ids count once;
fewer than min_samples points give all -1; clusters are numbered from 0 by size, then by least id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import written
from .components import connected_components
from .neighbours import knn_graph
from .ordering import with_index


def _ladder(lo: float, hi: float, levels: int) -> list[float]:
    if hi <= lo or levels < 2:
        return [hi]
    return [lo * (hi / lo) ** (i / (levels - 1)) for i in range(levels - 1)] + [hi]


def hdbscan(points: DataFrame, key: str, vector: str, min_cluster_size: int = 5, min_samples: int | None = None,
            neighbours: int = 15, levels: int = 32, metric: str = "euclidean") -> DataFrame:
    """(id, cluster) for every usable point; -1 is noise. Runs Spark jobs while it is built."""
    spark = points.sparkSession
    samples = min_samples or min_cluster_size
    graph = written(knn_graph(points, key, vector, k=max(neighbours, samples), metric=metric))
    nodes = written(graph.select(F.col("u").alias("id")).distinct())
    core = written(graph.groupBy(F.col("u").alias("id")).agg(
        F.max(F.when(F.col("rank") == samples - 1, F.col("d"))).alias("core"), F.count("*").alias("degree"))
        .select("id", F.when(F.lit(samples) <= 1, F.lit(0.0)).otherwise(F.col("core")).alias("core")))
    cu, cv = core.select(F.col("id").alias("u"), F.col("core").alias("cu")), core.select(
        F.col("id").alias("v"), F.col("core").alias("cv"))
    edges = written(graph.join(cu, "u").join(cv, "v").select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), F.greatest("cu", "cv", "d").alias("w"))
        .where(F.col("w").isNotNull()).groupBy("u", "v").agg(F.min("w").alias("w")))
    bounds = core.agg(F.min(F.when(F.col("core") > 0, F.col("core"))).alias("lo")).first()
    top = edges.agg(F.max("w").alias("hi"), F.min(F.when(F.col("w") > 0, F.col("w"))).alias("least")).first()
    if top["hi"] is None:
        return nodes.select("id", F.lit(-1).alias("cluster"))
    lo = min(x for x in (bounds["lo"], top["least"], top["hi"]) if x is not None)
    ladder = _ladder(lo, top["hi"], levels) if top["hi"] > 0 else [0.0]

    # components of all levels at once: node (level, point) and the edges present at that level, one layered graph
    numbered = written(with_index(core, ["id"], "ix"))
    n = numbered.count()
    levels_df = spark.createDataFrame(list(enumerate(ladder)), "level int, eps double")
    layered = (edges.join(numbered.select(F.col("id").alias("u"), F.col("ix").alias("iu")), "u")
               .join(numbered.select(F.col("id").alias("v"), F.col("ix").alias("iv")), "v")
               .join(F.broadcast(levels_df), F.col("w") <= F.col("eps"))
               .select((F.col("level") * n + F.col("iu")).alias("u"), (F.col("level") * n + F.col("iv")).alias("v")))
    present = numbered.join(F.broadcast(levels_df), F.col("core") <= F.col("eps")).select(
        "id", "level", (F.col("level") * n + F.col("ix")).alias("node"))
    found = connected_components(present.select("node"), layered)
    member = written(present.join(found, "node").select(
        "id", "level", (F.col("component") - F.col("level") * n).alias("cix")).join(
        numbered.select(F.col("ix").alias("cix"), F.col("id").alias("c")), "cix").select("id", "c", "level"))

    # the condensed tree of components with enough points
    sizes = member.groupBy("level", "c").agg(F.count("*").alias("size"))
    big = sizes.where(F.col("size") >= min_cluster_size)
    up = member.select(F.col("id").alias("c"), (F.col("level") - 1).alias("level"), F.col("c").alias("parent"))
    tree = written(big.join(up, ["level", "c"], "left"))
    children = tree.where(F.col("parent").isNotNull()).groupBy(F.col("level").alias("level"), "parent").agg(
        F.count("*").alias("big_children"))
    last = len(ladder) - 1
    roots = tree.where(F.col("level") == last).count()
    # siblings: the parent's children with enough points, all at this level
    tree = written(tree.join(children, ["level", "parent"], "left")
                   .select("level", "c", "size", "parent", F.coalesce("big_children", F.lit(0)).alias("siblings")))
    continues = (F.col("level") < last) & (F.col("siblings") == 1)
    link = tree.select("level", "c", "size", F.when(continues, F.col("level") + 1).alias("nl"),
                       F.when(continues, F.col("parent")).alias("nc"))
    # cluster = the component where the chain of only children starts, by pointer doubling
    chain = written(link.select("level", "c", "size", F.coalesce("nl", "level").alias("hl"),
                                F.coalesce("nc", "c").alias("hc")))
    while True:
        hop = chain.alias("a").join(chain.alias("b"), (F.col("a.hl") == F.col("b.level")) & (F.col("a.hc") == F.col(
            "b.c")), "left").select("a.level", "a.c", "a.size", F.col("a.hl").alias("ol"), F.col("a.hc").alias("oc"),
                                    F.coalesce("b.hl", "a.hl").alias("hl"), F.coalesce("b.hc", "a.hc").alias("hc"))
        hop = written(hop)
        if not hop.where((F.col("ol") != F.col("hl")) | (F.col("oc") != F.col("hc"))).limit(1).count():
            chain = hop.drop("ol", "oc")
            break
        chain = hop.drop("ol", "oc")
    steps = spark.createDataFrame([(i, (1 / ladder[i] if ladder[i] > 0 else 1e300)
                                    - (1 / ladder[i + 1] if i + 1 < len(ladder) and ladder[i + 1] > 0 else 0.0))
                                   for i in range(len(ladder))], "level int, step double")
    stability = (chain.where(F.col("level") < F.col("hl")).join(F.broadcast(steps), "level")
                 .groupBy("hl", "hc").agg(F.sum(F.col("size") * F.col("step")).alias("stability")))
    births = chain.where((F.col("level") == F.col("hl")) & (F.col("c") == F.col("hc"))).join(
        tree.select("level", "c", "parent"), ["level", "c"]).select(
        F.col("level").alias("hl"), F.col("c").alias("hc"), "size",
        F.when(F.col("level") < last, F.col("parent")).alias("pc"))
    # parent cluster of a cluster: the cluster of its parent component
    owner = chain.select(F.col("level").alias("pl"), F.col("c").alias("pc"), F.col("hl").alias("phl"),
                         F.col("hc").alias("phc"))
    clusters = written(births.join(stability, ["hl", "hc"], "left").withColumn("pl", F.col("hl") + 1)
                       .join(owner, ["pl", "pc"], "left").select(
                           "hl", "hc", "size", F.coalesce("stability", F.lit(0.0)).alias("stability"), "phl", "phc"))
    is_root = (F.col("phl").isNull() & F.lit(roots == 1))

    # excess of mass, bottom-up by birth level
    done = None
    for level in range(len(ladder)):
        here = clusters.where(F.col("hl") == level)
        if done is not None:
            sums = done.groupBy(F.col("phl").alias("hl"), F.col("phc").alias("hc")).agg(
                F.sum("best").alias("below"))
            here = here.join(sums, ["hl", "hc"], "left")
        else:
            here = here.withColumn("below", F.lit(None).cast("double"))
        here = here.select("hl", "hc", "size", "phl", "phc", "stability",
                           F.coalesce("below", F.lit(0.0)).alias("below"), F.col("below").isNull().alias("leaf"))
        chosen = ((F.col("leaf") | (F.col("stability") >= F.col("below"))) & ~is_root)
        step = here.select("hl", "hc", "size", "phl", "phc", chosen.alias("chosen"),
                           F.when(chosen, F.col("stability")).otherwise(F.col("below")).alias("best"))
        done = step if done is None else done.unionByName(step)
        done = written(done)
    # chosen clusters under a chosen ancestor give way, top-down
    final = None
    for level in reversed(range(len(ladder))):
        here = done.where(F.col("hl") == level)
        if final is not None:
            blocked = final.where(F.col("taken") | F.col("blocked")).select(
                F.col("hl").alias("phl"), F.col("hc").alias("phc"), F.lit(True).alias("up"))
            here = here.join(blocked, ["phl", "phc"], "left")
        else:
            here = here.withColumn("up", F.lit(None).cast("boolean"))
        step = here.select("hl", "hc", "size", F.coalesce("up", F.lit(False)).alias("blocked"),
                           (F.col("chosen") & F.coalesce("up", F.lit(False)).__invert__()).alias("taken"))
        final = step if final is None else final.unionByName(step)
        final = written(final)
    taken = final.where("taken").select(F.col("hl").alias("level"), F.col("hc").alias("c"), "size")
    labelled = member.join(taken, ["level", "c"]).select("id", "size", F.col("c").alias("first"), "level")
    # one row per chosen cluster, at most n / min_cluster_size
    numbers = taken.select("level", "c", "size").withColumn(
        "cluster", F.row_number().over(Window.orderBy(F.desc("size"), "c")) - 1)
    named = labelled.join(numbers.select("level", F.col("c").alias("first"), "cluster"), ["level", "first"])
    return nodes.join(named.select("id", "cluster"), "id", "left").select(
        "id", F.coalesce("cluster", F.lit(-1)).cast("int").alias("cluster"))
