"""Keep the first or the last row per key.

Both are aggregates, not windows: copies of a hot key are combined before the shuffle, so a key
with a third of all rows sends one row per input partition instead of meeting in one sorted task.
Project to the columns needed first; every remaining column travels with the key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[str],
          pick: Callable[[Column, Column], Column]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    kept = df.groupBy(*keys).agg(row)
    return kept.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key; ``order`` must tell all rows of a key apart. Null keys are equal."""
    return _keep(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key; ``order`` must tell all rows of a key apart. Null keys are equal."""
    return _keep(df, keys, order, F.max_by)


def drop_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in a table of keys seen before; a null key is never known."""
    return df.join(known.select(*keys), list(keys), "left_anti")


def save_key_history(keys: DataFrame, table: str, key_columns: Sequence[str], buckets: int = 64,
                     mode: str = "append") -> None:
    """Store seen keys as a table bucketed and sorted by the keys, in the session's warehouse.

    ``drop_known_bucketed`` then joins against it without moving it: only the new rows are shuffled, into the
    table's buckets. Choose ``buckets`` at least ``spark.sql.shuffle.partitions``, so the planner keeps the buckets.
    """
    (keys.select(*key_columns).write.mode(mode).bucketBy(buckets, *key_columns).sortBy(*key_columns)
     .saveAsTable(table))


def drop_known_bucketed(df: DataFrame, table: str, key_columns: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the bucketed key table; a null key is never known."""
    known = df.sparkSession.table(table).select(*key_columns)
    return df.join(known, list(key_columns), "left_anti")
