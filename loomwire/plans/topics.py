"""From vectors to numbered topics, and the summary of each topic."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.stopwords import ENGLISH
from ..functions.text import clean_text, title_and_summary, tokens_unicode
from ..operators.density import _distance, density_clusters, lattice_point, neighbour_cells
from ..operators.ordering import with_index
from ..operators.topic_terms import representative_docs, term_lists, topic_names, topic_terms
from ..operators.vectors import fit_reduction, hashed_embedding, reduce_dims
from ..schemas import CLUSTERED_COLUMNS, keep_columns
from ..session import in_tasks, written

OUTLIER = -1


@dataclass
class TopicModel:
    """A fitted reduction and the topic of every occupied lattice point."""

    reduction: PipelineModel
    points: DataFrame  # (point, topic)
    components: int
    eps: float
    fineness: int

    def assign(self, vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
        """Vectors with their topic; a place where no topic was seen gives -1."""
        reduced = reduce_dims(self.reduction, vectors, embedding, "_coords")
        return assign_points(reduced, "_coords", self.points, self.components, self.eps,
                             self.fineness).drop("_coords")

    def save(self, path: str) -> None:
        self.reduction.write().overwrite().save(f"{path}/reduction")
        self.points.write.mode("overwrite").parquet(f"{path}/points")
        (self.points.sparkSession.createDataFrame([(self.components, self.eps, self.fineness)],
                                                  "components int, eps double, fineness int")
         .write.mode("overwrite").parquet(f"{path}/settings"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TopicModel":
        settings = spark.read.parquet(f"{path}/settings").first()
        return TopicModel(PipelineModel.load(f"{path}/reduction"), spark.read.parquet(f"{path}/points"),
                          settings["components"], settings["eps"], settings["fineness"])


def assign_points(rows: DataFrame, coords: str, points: DataFrame, dims: int, eps: float,
                  fineness: int) -> DataFrame:
    """Rows with the topic of their lattice point. A point which holds many copies is split by the
    adaptive join, since the other side has one row per point.

    A lattice point that the fit did not see takes the topic of the nearest core point of a topic within eps (ties:
    the smaller topic), found through neighbouring cells as in the fit; without one it is an outlier (-1). Points of a model
    without core marks count as core when they have a topic.
    """
    placed = rows.withColumn("_point", lattice_point(coords, dims, eps, fineness))
    core = F.col("core") if "core" in points.columns else F.col("topic") != OUTLIER
    known = points.select(F.col("point").alias("_point"), "topic", core.alias("_core"))
    unseen = placed.select("_point").distinct().join(in_tasks(known), "_point", "left_anti")
    topics = known.select("_point", "topic").unionByName(_nearest_core(unseen, known, dims, fineness))
    return (placed.join(in_tasks(topics), "_point", "left").drop("_point")
            .withColumn("topic", F.coalesce("topic", F.lit(OUTLIER))))


def _nearest_core(unseen: DataFrame, known: DataFrame, dims: int, fineness: int) -> DataFrame:
    """(_point, topic) for lattice points the fit did not see: the nearest core point within eps, else -1."""
    limit = dims * fineness * fineness
    place, own, far = [f"p{i}" for i in range(dims)], [f"c{i}" for i in range(dims)], [f"q{i}" for i in range(dims)]

    def spread(df: DataFrame) -> DataFrame:
        coords = df.select("*", *[F.get("_point", F.lit(i)).alias(p) for i, p in enumerate(place)])
        return coords.withColumns({c: F.floor(F.col(p) / fineness).cast("long") for c, p in zip(own, place)})

    asked = spread(unseen)
    cores = spread(known.where(F.col("_core") & (F.col("topic") != OUTLIER)))
    cells = asked.select(*own).unionByName(cores.select(*own)).distinct().withColumn("node", F.xxhash64(*own))
    pairs = neighbour_cells(cells.select("node", *own), dims, fineness)
    near = cores.select(F.xxhash64(*own).alias("v"), "topic", *[F.col(p).alias(q) for p, q in zip(place, far)])
    found = (asked.withColumn("u", F.xxhash64(*own)).join(in_tasks(pairs), "u").join(in_tasks(near), "v")
             .where(_distance("p", "q", dims) <= limit)
             .groupBy("_point").agg(F.min(F.shiftleft(_distance("p", "q", dims), 32) + F.col("topic")).alias("best")))
    # distance and topic in one number: the minimum of a struct would sort every pair of a task
    return unseen.join(in_tasks(found), "_point", "left").select(
        "_point", F.coalesce(F.col("best").bitwiseAND(F.lit((1 << 32) - 1)), F.lit(OUTLIER)).cast("int").alias("topic"))


def numbered_points(rows: DataFrame, key: str, coords: str, dims: int, eps: float, min_pts: int = 5,
                    min_cluster_size: int = 5, fineness: int = 4) -> DataFrame:
    """(point, topic, core): clusters numbered by size, largest first, then by their least key."""
    clusters = density_clusters(rows, coords, dims, eps, min_pts, min_cluster_size, fineness)
    per_point = (rows.select(lattice_point(coords, dims, eps, fineness).alias("point"), F.col(key).alias("_key"))
                 .groupBy("point").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("first")))
    sizes = (clusters.where(F.col("cluster").isNotNull()).join(in_tasks(per_point), "point").groupBy("cluster")
             .agg(F.sum("n").alias("n"), F.min("first").alias("first")))
    numbers = with_index(sizes, [F.desc("n"), F.col("first")], "topic").select("cluster", "topic")
    return (clusters.join(in_tasks(numbers), "cluster", "left")
            .select("point", F.coalesce("topic", F.lit(OUTLIER)).cast("int").alias("topic"), "core"))


def fit_topics(vectors: DataFrame, key: str, embedding: str = "embedding", components: int = 5,
               eps: float = 0.15, min_pts: int = 5, min_cluster_size: int = 5, fineness: int = 4) -> TopicModel:
    """Reduce the vectors, cluster them by density and number the clusters."""
    vectors = written(vectors.select(key, embedding))  # fitting reads them several times
    reduction = fit_reduction(vectors, embedding, components)
    reduced = written(reduce_dims(reduction, vectors, embedding).select(key, "coords"))
    points = written(numbered_points(reduced, key, "coords", components, eps, min_pts, min_cluster_size, fineness))
    return TopicModel(reduction, points, components, eps, fineness)


def clustered_articles(articles: DataFrame, key: str, width: int = 384, stop: Sequence[str] = ENGLISH,
                       encode: Callable[[DataFrame], DataFrame] | None = None, **fit) -> tuple[DataFrame, TopicModel]:
    """Articles with ``text_clean`` and ``topic``, as far as they have them the columns ``CLUSTERED_COLUMNS``, and the model.

    This is the table that ``trend_scores`` takes. ``encode`` adds an ``embedding`` column to the articles; hashed words
    are used without it. ``fit`` goes to ``fit_topics``.
    """
    cleaned = articles.withColumn("text_clean", clean_text(title_and_summary(), stop))
    if encode is None:
        embedded = cleaned.withColumn("embedding", hashed_embedding(tokens_unicode("text_clean"), width))
    else:
        embedded = encode(cleaned)
    rows = written(embedded)
    model = fit_topics(rows, key, **fit)
    assigned = model.assign(rows.select(key, "embedding")).select(F.col(key).alias("_key"), "topic")
    # vectors stay out of the join with the articles
    joined = rows.drop("embedding").join(assigned, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    return keep_columns(joined, (key, *CLUSTERED_COLUMNS)), model


def topic_info(docs: DataFrame, key: str, topic: str, tokens: str, text: str, n_terms: int = 10,
               n_docs: int = 3) -> DataFrame:
    """One row per topic: (Topic, Count, Name, Representation, Representative_Docs)."""
    terms = topic_terms(docs, topic, tokens, n_terms)
    lists = term_lists(terms)
    chosen = representative_docs(docs, key, topic, tokens, terms, n_docs)
    # texts are fetched for the chosen documents only
    texts = (docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
             .join(chosen.select(F.col(key).alias("_key"), F.col("topic").alias("_topic"), "rank"), "_key")
             .groupBy("_topic").agg(F.array_sort(F.collect_list(F.struct("rank", "_text"))).alias("_docs")))
    counts = docs.groupBy(F.col(topic).alias("topic")).agg(F.count(F.lit(1)).alias("count"))
    return (counts.join(lists, "topic", "left").join(topic_names(lists), "topic", "left")
            .join(texts, F.col("topic") == F.col("_topic"), "left")
            .select(F.col("topic").alias("Topic"), F.col("count").alias("Count"), F.col("name").alias("Name"),
                    F.col("terms").alias("Representation"),
                    F.transform("_docs", lambda d: d["_text"]).alias("Representative_Docs")))
