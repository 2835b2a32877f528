"""Versioned tables: one partition per run, stamped ``YYYYMMDD_HHMMSS`` in UTC."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .files import list_files


def read_all(spark: SparkSession, root: str) -> DataFrame:
    """Every run of a table; runs with more or fewer columns are aligned by name."""
    return spark.read.option("mergeSchema", True).parquet(root)


def read_latest(spark: SparkSession, root: str, before: str | None = None) -> DataFrame:
    """The newest run, or the newest one before a stamp. The run is chosen from the file listing,
    so the files of older runs are not opened."""
    run = F.regexp_extract("path", r"/run_ts=([^/]+)/", 1)
    files = list_files(spark, root, "*.parquet", below=True).select(
        run.alias("run_ts"), F.regexp_extract("path", r"^(.*/run_ts=[^/]+)/", 1).alias("folder"))
    if before is not None:
        files = files.where(F.col("run_ts") < before)
    folder = files.where(F.col("run_ts") != "").agg(F.max_by("folder", "run_ts")).first()[0]
    if folder is None:
        raise FileNotFoundError(f"no run in {root}")
    return spark.read.parquet(folder)


def read_previous(spark: SparkSession, root: str, schema: T.StructType, before: str | None = None) -> DataFrame:
    """Like ``read_latest``; a table which does not exist yet is empty."""
    try:
        return read_latest(spark, root, before)
    except FileNotFoundError:
        return spark.createDataFrame([], schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def union_snapshots(*snapshots: DataFrame) -> DataFrame:
    """All rows of all snapshots by column name; a column which one lacks is null there."""
    out = snapshots[0]
    for other in snapshots[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def new_since(current: DataFrame, processed: DataFrame, keys: list[str]) -> DataFrame:
    """Entries of a listing which a manifest of processed entries does not have."""
    return current.join(processed.select(*keys), keys, "left_anti")
