"""Writers: stamped snapshots, the latest copy, CSV exports, the dated archive."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.files import export_name, export_of_row, headers, list_exports, read_csv
from ..sources.snapshots import new_since

# How runs and days are named.
STAMP_NAME, STAMP_PATTERN = "%Y%m%d_%H%M%S", "yyyyMMdd_HHmmss"
DAY_NAME, DAY_PATTERN = "%d-%m-%Y", "dd-MM-yyyy"


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime(STAMP_NAME)


def _day(run_ts: Column) -> Column:
    return F.date_format(F.to_timestamp(run_ts, STAMP_PATTERN), "yyyy-MM-dd")


def write_snapshot(df: DataFrame, root: str, run_ts: str) -> None:
    """Add one run to a versioned table. The run is one partition, and writing it again replaces it,
    so a job which is repeated after a failure stores nothing twice."""
    stamped = df.withColumns({"run_date": _day(F.lit(run_ts)), "run_ts": F.lit(run_ts)})
    (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date", "run_ts").parquet(root))


def write_latest(spark: SparkSession, root: str, run_ts: str, path: str) -> None:
    """Overwrite the convenience copy with a stored run. It is read from the stored run and not from
    the query behind it, which may itself read the copy."""
    (spark.read.parquet(root).where(F.col("run_ts") == run_ts).drop("run_date", "run_ts")
     .write.mode("overwrite").parquet(path))


def flatten(df: DataFrame) -> DataFrame:
    """Array columns as ``", "``-joined text, for CSV."""
    return df.select(*[F.array_join(c, ", ").alias(c) if kind == "array<string>" else F.col(c)
                       for c, kind in df.dtypes])


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quotes doubled inside quotes."""
    (flatten(df).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .csv(path))


def write_sheets(path: str, **sheets: DataFrame) -> None:
    """Several small tables of the same columns under one path, one partition per sheet."""
    for name, df in sheets.items():
        (df.withColumn("sheet", F.lit(name)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("sheet").parquet(path))


def archive_day(run_date: Column) -> Column:
    return F.date_format(run_date, DAY_PATTERN)


def archive_new(spark: SparkSession, folder: str, before: DataFrame, archive: str, day: datetime,
                prefix: str) -> DataFrame:
    """Copy the CSV files of one kind which are new since a listing into the day's archive partition.

    Copies named ``*_latest*`` stay out. Returns the listing of what was archived.
    """
    files = list_exports(spark, folder, f"{prefix}_*.csv").where(~F.contains("name", F.lit("_latest")))
    fresh = new_since(files, before, ["path"])
    # files of one header are read together; each file is one partition, and storing it again replaces it
    heads = headers(spark, folder, f"{prefix}_*.csv").select("header", F.explode("paths").alias("path"))
    named = heads.withColumn("name", export_name("path")).join(fresh.select("name"), "name", "left_semi")
    for row in named.groupBy("header").agg(F.collect_list("path").alias("paths")).collect():
        rows = read_csv(spark, row["paths"])
        (rows.withColumns({"source_file": export_of_row(), "run_day": F.lit(day.strftime(DAY_NAME))})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_day", "source_file")
         .parquet(archive))
    return fresh
