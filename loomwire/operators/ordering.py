"""A dense number for every row of a globally sorted table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

_PARTITION_SHIFT = 33  # layout of monotonically_increasing_id: partition number above 33 bits


def with_index(df: DataFrame, order: Sequence[str | Column], name: str = "index") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order, in parallel.

    The sorted rows are written first, so that a task which runs again finds the same numbers. Only one
    row per partition, its size, is put in sequence.
    """
    ordered = written(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", _PARTITION_SHIFT).alias("_part")
    sizes = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.col("_id") - F.shiftleft("_part", _PARTITION_SHIFT)
    return (ordered.withColumn("_part", part).join(starts, "_part")
            .withColumn(name, F.col("_start") + inside).drop("_part", "_start", "_id"))
