"""Polling landed feed documents: each run takes the documents which no run has taken before.

The file source remembers in its checkpoint which documents were read, so this needs no state of its
own. Every batch is deduplicated in itself and against the stored keys, as a batch run is.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.feeds import article_rows, items, numbered, with_feed_order


def poll_feeds(spark: SparkSession, folder: str, table: str, checkpoint: str, seed: DataFrame,
               feeds: DataFrame | None = None) -> StreamingQuery:
    """Take all new documents below ``folder`` into the article table, then stop.

    One batch is one folder of the table, named by the checkpoint and the batch's number: a batch repeated after a failure
    replaces its own rows, and a new checkpoint on an old table overwrites nothing. All stored keys but the
    batch's own are known.
    """
    try:
        run = spark.read.parquet(f"{checkpoint}/run").first()[0]
    except AnalysisException:  # a new checkpoint
        run = uuid.uuid4().hex
        spark.createDataFrame([(run,)], "name string").coalesce(1).write.parquet(f"{checkpoint}/run")

    def store(batch: DataFrame, number: int) -> None:
        own = f"{run}-{number}"
        try:
            known = spark.read.parquet(table).where(F.col("batch") != own)
        except AnalysisException:  # no table yet
            known = None
        rows = article_rows(with_feed_order(numbered(batch), feeds), seed, known=known)
        rows.drop("feed_ord", "item_ord").write.mode("overwrite").parquet(f"{table}/batch={own}")

    return (items(spark.readStream, folder).writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
