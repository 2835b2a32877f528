"""CSV exports: reading, choosing the newest one, reading all of them.

An export is a file, or a folder of that name with the parts that Spark's tasks wrote, each with the header. Line breaks may
be inside quotes, so a file or part is read by one task: large exports have to come in parts.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_PART = r"(\.csv)/part-(\d+)[^/]*$"  # of an export in parts
STAMP = r"\d{8}_\d{6}"  # fixed value: YYYYMMDD_HHMMSS in UTC


def _text_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text under the header's names. Quotes are doubled inside quotes, line breaks may be inside quotes."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", True).csv(path))


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns by name; absent ones are null, and so is what cannot be cast."""
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
                       .alias(f.name) for f in schema])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Files of one header. With a schema its columns are taken by name, in whatever order the file has them."""
    df = _text_csv(spark, path)
    return df if schema is None else _typed(df, _schema(schema))


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def export_path(path: Column | str) -> Column:
    """The path of the export to which a file belongs: its own, or that of the folder of its parts."""
    return F.regexp_replace(path, _PART, "$1")


def export_name(path: Column | str) -> Column:
    return F.regexp_extract(export_path(path), r"([^/]+)$", 1)


def export_of_row() -> Column:
    """The name of the export from which a row was read."""
    path = F.col("_metadata.file_path")
    return F.when(path.rlike(_PART), export_name(path)).otherwise(F.col("_metadata.file_name"))


def list_exports(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(path, name) of the CSV exports in a folder."""
    files = list_files(spark, folder, glob)
    return files.select(export_path("path").alias("path"), export_name("path").alias("name")).distinct()


def list_files(spark: SparkSession, folder: str, glob: str = "*", below: bool = False) -> DataFrame:
    """(path, name) of the files in a folder, with ``below`` also in folders within; their content is not opened."""
    reader = spark.read.format("binaryFile")
    if below:
        listing = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    else:
        try:
            listing = reader.load(f"{folder}/{glob}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            listing = spark.createDataFrame([], "path string")
    return listing.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))


def headers(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(header, paths): the first lines of the files in a folder and the files which begin with each."""
    try:
        lines = spark.read.text(f"{folder}/{glob}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "header string, paths array<string>")
    lines = lines.select(
        "value", F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"))
    first = lines.where("block = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    return first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def newest_raw(spark: SparkSession, folder: str, prefix: str, column: str = "ingested_at") -> str:
    """Path of the newest ``prefix_<stamp>.csv``, else of the newest ``prefix_*.csv`` whose header has
    the column. Raises FileNotFoundError when there is neither."""
    files = list_exports(spark, folder, f"{prefix}_*.csv")
    strict = files.where(F.col("name").rlike(f"^{prefix}_{STAMP}\\.csv$"))
    best = strict.agg(F.max_by("path", "name")).first()[0]
    if best:
        return best
    # headers of all files in one job
    names = headers(spark, folder, f"{prefix}_*.csv")
    with_column = names.where(F.array_contains(F.split(F.regexp_replace("header", '"', ""), ","), column))
    best = with_column.select(F.explode("paths").alias("path")).agg(F.max(export_path("path"))).first()[0]
    if best:
        return best
    raise FileNotFoundError(f"no {prefix}_*.csv with a column {column} in {folder}")


def newest(spark: SparkSession, folder: str, prefix: str, fallback: bool = True) -> str:
    """Path of the newest ``prefix_*.csv``, else of ``prefix.csv`` if a fallback is wanted."""
    best = list_exports(spark, folder, f"{prefix}_*.csv").agg(F.max_by("path", "name")).first()[0]
    if best is None and fallback:
        best = list_exports(spark, folder, f"{prefix}.csv").agg(F.max("path")).first()[0]
    if best is None:
        raise FileNotFoundError(f"no {prefix}_*.csv in {folder}")
    return best


def _order(path: str, number: str) -> Column:
    """The place of a row in its export: its part, then its number within the task that read the whole part."""
    part = F.regexp_extract(path, _PART, 2)
    inside = F.col(number).bitwiseAND(F.lit((1 << 33) - 1))
    return F.when(part == "", F.col(number)).otherwise(F.shiftleft(F.nullif(part, F.lit("")).cast("long"), 33) + inside)


def all_history(spark: SparkSession, folder: str, prefix: str, schema: T.StructType | str) -> DataFrame:
    """All ``prefix_*.csv`` as one table with ``source_file`` and ``row_ord``, which orders the rows of
    one file. Columns are matched by name: files of one header are read together, a column which they lack is null."""
    schema = _schema(schema)
    out = spark.createDataFrame([], schema).withColumns(
        {"source_file": F.lit(None).cast("string"), "row_ord": F.lit(None).cast("long")})
    for row in headers(spark, folder, f"{prefix}_*.csv").orderBy("header").collect():  # a few kinds of header
        read = _text_csv(spark, row["paths"]).withColumns(
            {"_file": export_of_row(), "_path": F.col("_metadata.file_path"), "_at": F.monotonically_increasing_id()})
        named = [f for f in schema if f.name in read.columns]
        columns = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in named]
        rows = read.select(*columns, F.col("_file").alias("source_file"), _order("_path", "_at").alias("row_ord"))
        out = out.unionByName(rows, allowMissingColumns=True)
    return out


def left_out(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """(path, name) of the ``prefix_*.csv`` of which history holds no row, as they have a header alone. Spark lists no files
    of no bytes."""
    glob = f"{prefix}_*.csv"
    try:
        rows = spark.read.text(f"{folder}/{glob}").select(
            F.col("_metadata.file_path").alias("path"), export_of_row().alias("name"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], "path string, name string")
    filled = rows.groupBy("path", "name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    return list_exports(spark, folder, glob).join(filled, "name", "left_anti").select("path", "name")


def non_empty(df: DataFrame, what: str) -> DataFrame:
    """The table itself, or ValueError when it has no row."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df
