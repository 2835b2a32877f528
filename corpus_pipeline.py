"""From raw documents to packed sequences: five stages, each over all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomwire.llm import compression, line_dedup, mixing, packing, superminhash
from loomwire.llm.queries import WEIGHTS, mix_levels, tokenizer
from loomwire.session import shared_folder, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text passes the base rules and the compression bands."""
    return compression.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document or line has; documents left without a word go."""
    left = line_dedup.dedup_lines(docs).where(F.length("text") > 0)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and all documents without an id, each of which is alone."""
    kept = superminhash.near_duplicates(docs).where("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def _in_files(docs: DataFrame) -> DataFrame:
    """docs as a table whose rows have a place in a file."""
    try:
        docs.select("_metadata.row_index").schema
        return docs
    except AnalysisException:
        return written(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source up to its budget; rows go by their place in the stage's input, as ids may be null or repeated."""
    rows = _in_files(docs)
    at = {"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.row_index")}
    taken = mixing.mix(rows, mix_levels(), WEIGHTS, share=(4, 5), epochs=1, seed=7, carry=at).where("copies > 0")
    return rows.withColumns(at).join(taken.select(*at), list(at), "left_semi").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs, tokenizer())


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup_stage), ("near dedup", near_dedup),
          ("source mix", mix_sources), ("packing", pack_sequences)]

# The first, third and last stage have no SQL form; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
