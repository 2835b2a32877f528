"""Weekly mentions kept up to date one batch at a time, instead of reading all history again.

The state is two tables in one folder:

* ``kept``: the last copy of every article key (link, title, topic) with its order, week and source, partitioned by a
  hash bucket of the key;
* ``weekly``: (topic, year_week, source, mentions_by_source), partitioned by week.

A step reads the batch and only the buckets its keys fall in. Per key the last copy of old and new wins (keep-last as
in ``scored_articles``). When a new copy replaces a stored one, the stored copy's mention is retracted and the new one
added; a late copy older than the stored one changes nothing. The deltas are added to the touched weeks only, and only
touched buckets and weeks are rewritten (dynamic partition overwrite), from tables written first, so no step reads a
partition it is overwriting. After any sequence of batches the weekly table equals ``weekly_mentions`` of all batches
at once.

Defined results: rows without a valid time are dropped (as in ``scored_articles``); null key parts are equal to each
other; repeated rows within a batch count once per key; an empty batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.dedupe import keep_last
from ..session import written
from .trend import DEDUPE_KEYS, scored_articles

BUCKETS = 64


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in DEDUPE_KEYS]),
                  F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def _overwrite(df: DataFrame, path: str, column: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def step(spark: SparkSession, state: str, batch: DataFrame, order: Sequence[str], buckets: int = BUCKETS) -> None:
    """Fold one batch of articles into the state folder (created by the first step)."""
    fresh = scored_articles(batch, order).select(*DEDUPE_KEYS, *order, "year_week", "source")
    fresh = written(keep_last(fresh, DEDUPE_KEYS, [*order, "year_week", "source"]).withColumn("bucket", _bucket(buckets)))
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    kept_path, weekly_path = f"{state}/kept", f"{state}/weekly"
    if _exists(spark, kept_path):
        stored = spark.read.parquet(kept_path).where(F.col("bucket").isin(touched)).select(*fresh.columns)
    else:
        stored = fresh.limit(0)
    both = stored.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)))
    winners = written(keep_last(both, DEDUPE_KEYS, [*order, "_new"]))
    keys = [F.col(f"s.{k}").eqNullSafe(F.col(f"w.{k}")) for k in DEDUPE_KEYS]
    on = keys[0]
    for more in keys[1:]:
        on = on & more
    replaced = (stored.alias("s").join(winners.where("_new").alias("w"), on, "left_semi")
                .select("topic", "year_week", "source", F.lit(-1).cast("long").alias("delta")))
    added = winners.where("_new").select("topic", "year_week", "source", F.lit(1).cast("long").alias("delta"))
    deltas = written(replaced.unionByName(added).groupBy("topic", "year_week", "source").agg(
        F.sum("delta").alias("delta")))
    weeks = [r["year_week"] for r in deltas.select("year_week").distinct().collect()]  # weeks of one batch
    if _exists(spark, weekly_path):
        counts = spark.read.parquet(weekly_path).where(F.col("year_week").isin(weeks)).select(
            "topic", "source", "mentions_by_source", "year_week")
    else:
        counts = spark.createDataFrame([], "topic string, source string, mentions_by_source long, year_week string")
    updated = written(counts.withColumnRenamed("mentions_by_source", "delta").unionByName(
        deltas.select("topic", "source", "delta", "year_week")).groupBy("topic", "year_week", "source").agg(
        F.sum("delta").alias("mentions_by_source"))
        # rows that fall to 0 stay, so that a week which loses all its mentions is rewritten too
        .select("topic", "source", "mentions_by_source", "year_week"))
    _overwrite(updated, weekly_path, "year_week")
    _overwrite(winners.drop("_new"), kept_path, "bucket")


def weekly(spark: SparkSession, state: str) -> DataFrame:
    """(topic, year_week, source, mentions_by_source) of the state."""
    return (spark.read.parquet(f"{state}/weekly").where(F.col("mentions_by_source") != 0)
            .select("topic", "year_week", "source", "mentions_by_source"))
