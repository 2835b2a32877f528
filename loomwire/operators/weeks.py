"""Counts per topic, week and source, and the weeks which occur.

Everything the trend score needs, but for the headlines, follows from the one table of
``weekly_mentions``. It has one row per (topic, week, source) however many articles there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scores import recency, velocity
from ..functions.weeks import year_week


def weekly_mentions(articles: DataFrame) -> DataFrame:
    """(topic, year_week, source, mentions_by_source)."""
    return (articles.groupBy("topic", "year_week", "source")
            .agg(F.count(F.lit(1)).alias("mentions_by_source")))


def topic_weeks(weekly: DataFrame) -> DataFrame:
    """(topic, year_week, mentions)."""
    return weekly.groupBy("topic", "year_week").agg(F.sum("mentions_by_source").alias("mentions"))


def week_histogram(weekly: DataFrame) -> DataFrame:
    """(year_week, articles): how many articles every observed week has."""
    return weekly.groupBy("year_week").agg(F.sum("mentions_by_source").alias("articles"))


def recent_weeks(weekly: DataFrame, n: int = 6) -> DataFrame:
    """The last n observed weeks; gaps are skipped."""
    return week_histogram(weekly).where(F.col("year_week").isNotNull()).orderBy(F.desc("year_week")).limit(n)


def observed_weeks(weekly: DataFrame, n: int = 2) -> Column:
    """The last n observed weeks with their sizes, latest first, as an array which any query can use.

    The sizes stay in: without them the counts would be pruned from this use of the weekly table, and
    Spark would no longer see that it can reuse its shuffle.
    """
    return recent_weeks(weekly, n).agg(
        F.sort_array(F.collect_list(F.struct("year_week", "articles")), asc=False).alias("weeks")).scalar()


def with_observed_weeks(df: DataFrame, weekly: DataFrame) -> DataFrame:
    """Add ``latest`` and ``previous``, the last two observed weeks; previous is null when there is one.

    The look-up is one column, which the others refer to: written out twice it would be planned twice.
    """
    found = df.withColumn("_weeks", observed_weeks(weekly))
    return found.withColumns({"latest": F.get("_weeks", F.lit(0))["year_week"],
                              "previous": F.get("_weeks", F.lit(1))["year_week"]}).drop("_weeks")


def _previous_monday_week(latest: Column) -> Column:
    """The calendar week before a ``YYYY-WW`` week: that of the day before the week's first day."""
    new_year = F.make_date(F.substr(latest, F.lit(1), F.lit(4)).cast("int"), F.lit(1), F.lit(1))
    week = F.substr(latest, F.lit(6)).cast("int")
    first_monday = F.date_add(new_year, F.pmod(7 - F.weekday(new_year), F.lit(7)))
    first_day = F.when(week == 0, new_year).otherwise(F.date_add(first_monday, 7 * (week - 1)))
    return year_week(F.date_sub(first_day, 1))


def this_and_previous(weekly: DataFrame, calendar_prev: bool = False) -> DataFrame:
    """Per topic the mentions of the latest and the previous week, and the latest week's sources.

    Topics seen in older weeks only stay, with zeros. The previous week is the previous observed
    one, or with ``calendar_prev`` the calendar week before.
    """
    week, n, latest = F.col("year_week"), F.col("mentions_by_source"), F.col("latest")
    previous = _previous_monday_week(latest) if calendar_prev else F.col("previous")
    return with_observed_weeks(weekly, weekly).groupBy("topic").agg(
        F.sum(F.when(week == latest, n).otherwise(0)).alias("mentions_this_week"),
        F.sum(F.when(week == previous, n).otherwise(0)).alias("mentions_prev_week"),
        F.count(F.when(week == latest, F.col("source"))).alias("source_count"))


def with_metrics(counts: DataFrame) -> DataFrame:
    """Add velocity and recency to the counts of ``this_and_previous``."""
    this, prev = F.col("mentions_this_week"), F.col("mentions_prev_week")
    return counts.withColumns({"velocity": velocity(this, prev), "recency": recency(this, prev)})


def of_latest_week(articles: DataFrame, weekly: DataFrame) -> DataFrame:
    """The articles of the latest observed week."""
    return with_observed_weeks(articles, weekly).where("year_week = latest").drop("latest", "previous")


def source_sketches(articles: DataFrame, lg_config_k: int = 12) -> DataFrame:
    """(topic, year_week, sources): an HLL sketch of the distinct non-null sources of each topic and week.

    Sketches of other days, runs or partitions merge with ``merge_source_sketches``, so a daily step adds its day's
    sketch to the stored ones instead of reading all history again. Relative standard error about 1.04 / 2^(k/2)
    (1.6 % for k = 12); small counts are nearly exact.
    """
    return articles.groupBy("topic", "year_week").agg(F.hll_sketch_agg("source", lg_config_k).alias("sources"))


def merge_source_sketches(*tables: DataFrame) -> DataFrame:
    """One sketch per (topic, year_week) from several tables of ``source_sketches``."""
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("topic", "year_week").agg(F.hll_union_agg("sources", True).alias("sources"))


def approx_source_diversity(sketches: DataFrame) -> DataFrame:
    """(topic, source_count): estimated distinct sources in the latest observed week; 0 for topics not in it."""
    latest = sketches.agg(F.max("year_week").alias("latest"))
    return (sketches.join(latest, F.col("year_week") == F.col("latest"), "left").groupBy("topic")
            .agg(F.coalesce(F.max(F.when(F.col("latest").isNotNull(), F.hll_sketch_estimate("sources"))), F.lit(0))
                 .alias("source_count")))
