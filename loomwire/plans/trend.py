"""Weekly trend scores of topics over all history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scores import CLIP, WEIGHTS, clip, min_max, trend_score
from ..functions.web import source_host
from ..functions.weeks import parse_ts, year_week
from ..operators.dedupe import keep_last
from ..operators.weeks import of_latest_week, this_and_previous, weekly_mentions, with_metrics
from ..schemas import require_columns

DEDUPE_KEYS = ("link", "title", "topic")


def scored_articles(articles: DataFrame, order: Sequence[str], iso: bool = False) -> DataFrame:
    """Articles with a valid time, the last copy of each, with source and week key.

    ``order`` tells the rows apart from first to last, for example ("source_file", "row_ord"). Rows which it does not
    tell apart follow each other by their other columns, so the result never depends on partitions.
    Without a link column nothing is deduplicated and the source is ``unknown``.
    """
    require_columns(articles, ["ingested_at", "topic", "title", *order])
    has_link = "link" in articles.columns
    extra = [c for c in ("link", "source") if c in articles.columns]
    narrow = articles.select("title", "topic", *dict.fromkeys(["ingested_at", *order, *extra]))
    if dict(narrow.dtypes)["ingested_at"] == "string":
        narrow = narrow.withColumn("ingested_at", parse_ts("ingested_at"))
    narrow = narrow.where(F.col("ingested_at").isNotNull())
    if has_link:
        rest = [c for c in narrow.columns if c not in order and c not in DEDUPE_KEYS]
        narrow = keep_last(narrow, DEDUPE_KEYS, [*order, *rest])
    if "source" not in extra:
        narrow = narrow.withColumn("source", source_host("link") if has_link else F.lit("unknown"))
    return narrow.withColumns({"topic": F.col("topic").cast("string"),
                               "year_week": year_week("ingested_at", iso)})


def representative_headlines(articles: DataFrame, weekly: DataFrame, order: Sequence[str],
                             n: int = 3, separator: str = " || ") -> DataFrame:
    """(topic, rep_headlines): the first n distinct titles of each topic in the latest week.

    The rank limit is applied before the shuffle by topic, so a hot topic sends n rows a partition.
    """
    seen = (of_latest_week(articles, weekly).groupBy("topic", "title")
            # the null test sits on the aggregate: on the key it would be pushed below the
            # deduplication and give it another shuffle than the counts use
            .agg(F.min(F.when(F.col("title").isNotNull(), F.struct(*order))).alias("pos"))
            .where(F.col("pos").isNotNull()))
    rank = F.row_number().over(Window.partitionBy("topic").orderBy("pos", "title"))
    first = seen.withColumn("rank", rank).where(F.col("rank") <= n)
    titles = F.array_sort(F.collect_list(F.struct("rank", "title")))
    return first.groupBy("topic").agg(
        F.array_join(F.transform(titles, lambda t: t["title"]), separator).alias("rep_headlines"))


def normalised(metrics: DataFrame, bound: float = CLIP) -> DataFrame:
    """Min-max norms of clipped velocity, recency and source count over all topics."""
    clipped = metrics.withColumn("_clipped", clip("velocity", bound))
    inputs = {"velocity_norm": "_clipped", "recency_norm": "recency", "source_norm": "source_count"}
    ranges = clipped.agg(F.struct(*[f(c).alias(f"{c}_{n}") for c in inputs.values()
                              for n, f in (("low", F.min), ("high", F.max))]).alias("ranges")).scalar()
    return clipped.withColumn("_ranges", ranges).withColumns(
        {out: min_max(F.col(c), F.col(f"_ranges.{c}_low"), F.col(f"_ranges.{c}_high"))
         for out, c in inputs.items()}).drop("_clipped", "_ranges")


def with_scores(metrics: DataFrame, weights: tuple[float, float, float] = WEIGHTS,
                bound: float = CLIP) -> DataFrame:
    return normalised(metrics, bound).withColumn(
        "trend_score", trend_score("velocity_norm", "recency_norm", "source_norm", weights))


def with_previous(scores: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Add score_prev and score_delta; topics are compared as text, new topics give nulls."""
    if previous is None:
        return scores.withColumns({"score_prev": F.lit(None).cast("double"),
                                   "score_delta": F.lit(None).cast("double")})
    prev = previous.select(F.col("topic").cast("string").alias("topic"),
                           F.col("trend_score").alias("score_prev"))
    return (scores.withColumn("topic", F.col("topic").cast("string")).join(prev, "topic", "left")
            .withColumn("score_delta", F.col("trend_score") - F.col("score_prev")))


def trend_scores(articles: DataFrame, order: Sequence[str], previous: DataFrame | None = None, weights: tuple[float, float, float] = WEIGHTS,
                 bound: float = CLIP, headlines: int = 3, iso: bool = False,
                 calendar_prev: bool = False) -> DataFrame:
    """One row per topic ever seen, with the columns of ``schemas.TREND_SCORES``."""
    kept = scored_articles(articles, order, iso)
    weekly = weekly_mentions(kept)
    scores = with_scores(with_metrics(this_and_previous(weekly, calendar_prev)), weights, bound)
    titles = representative_headlines(kept, weekly, order, headlines)
    out = with_previous(scores.join(titles, "topic", "left"), previous)
    return out.select(
        "topic", "mentions_this_week", "mentions_prev_week", "velocity", "recency", "source_count",
        F.coalesce("rep_headlines", F.lit("")).alias("rep_headlines"), "velocity_norm",
        "recency_norm", "source_norm", "trend_score", "score_prev", "score_delta")


def top_topics(scores: DataFrame, n: int = 10) -> DataFrame:
    """The n topics with the highest score; equal scores are ordered by topic."""
    return (scores.orderBy(F.desc("trend_score"), "topic").limit(n)
            .select("topic", "trend_score", "mentions_this_week", "source_count"))


def topics_as_text(articles: DataFrame) -> DataFrame:
    """(topic): the different topics in the order of their text, 10 before 2."""
    return articles.select(F.col("topic").cast("string").alias("topic")).where(F.col("topic").isNotNull()).distinct().orderBy("topic")
