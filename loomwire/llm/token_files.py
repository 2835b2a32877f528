"""Token ids in ORC files, in ascending doc_id order.

ORC writes integers run-length encoded in stripes, keeps an index of every ``row_stride`` rows with the least and greatest
doc_id, and a Bloom filter of doc_id per stride. Stripes are read in parallel; a look-up by doc_id reads only
the strides that may hold it.

Files follow a range partitioning, so they hold disjoint ascending ranges. A file knows the place of its documents
in its own part; the places in the whole stream come from the sums of the parts before, when the files are read.

Defined results: null text counts as empty, the end id alone; documents with a null id come first; an empty table gives an
empty folder of files which reads as no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .tokens import by_bytes, crc32, encoder

FILE = "doc_id long, part long, part_start long, n_tokens long, ids array<int>"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, row_stride: int = 1000,
                      stripe_bytes: int = 16 << 20, bloom_fpp: float = 0.01, key: str = "doc_id",
                      text: str = "text") -> None:
    """Write the ids of every document, with end_id behind them."""
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, end_id).encode
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in by_bytes(batch, 1):
                ids, bounds, _ = encode(pc.fill_null(some.column(1), ""))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.full(some.num_rows, part), pa.int64()),
                     pa.array(before + bounds[:-1], pa.int64()), pa.array(np.diff(bounds), pa.int64()), lists],
                    [c.split()[0] for c in FILE.split(", ")])
                before += len(ids)

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(encoded, FILE)
    (ordered.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(bloom_fpp))
     .option("orc.row.index.stride", str(row_stride)).option("orc.stripe.size", str(stripe_bytes))
     .option("orc.create.index", "true").option("compression", "zstd").orc(path))


def _placed(files: DataFrame, rows: DataFrame) -> DataFrame:
    """rows of the files with start, their place among the ids of all documents."""
    # a row per file; its reading touches two columns
    ends = files.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("size"))
    before = ends.select("part", F.coalesce(F.sum("size").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(before, "part").withColumn("start", F.col("before") + F.col("part_start"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids: start counts the ids of all documents before."""
    files = spark.read.schema(FILE).orc(path)
    return _placed(files, files).select("doc_id", "start", "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of some documents; the indexes leave other stripes unread."""
    return spark.read.schema(FILE).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def checked_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens (counted in the ids) and ids_crc32 of every document. The ids are not shuffled."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            offsets = np.asarray(lists.offsets)
            flat = np.asarray(lists.values).astype("<u4")
            crc = [crc32(flat[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(offsets), pa.int64()),
                                              pa.array(crc, pa.int64())],
                                             ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    files = spark.read.schema(FILE).orc(path)
    rows = files.select("doc_id", "part", "part_start", "ids").mapInArrow(
        sums, "doc_id long, part long, part_start long, n_tokens long, ids_crc32 long")
    return _placed(files, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
