"""Exact deduplication by a tree of merged digest runs.

Each partition of the input is a sorted run of (digest, best id, count). In a round the runs of ``fan_in``
neighbours, a power of two and so that many binomial rounds at once, are exchanged by digest slice and merged:
of equal digests the best row stays, verified by a second hash and the length, which are part of the key.
After the last round one logical run is left, spread over all tasks by digest. The same tree is then followed
back: every row of a run finds its digest in the merged run above it, so no step gathers all copies of a digest:
a join meets those of ``fan_in`` runs at most.

Only digests move, never texts. Each level is a table in the shared folder.

Defined results: null text counts as empty; texts are equal when identical after lower-casing A-Z; of equal texts the row
with the largest (or smallest) id stays; of rows which share that id too, one; a null id is below all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .words import ascii_lower

RUN = "run long, digest binary, check long, bytes long, doc_id long, row long, n long"


def _digests(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row per document with its run, the partition of the input that holds it."""
    plain = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(key).cast("long").alias("doc_id"), plain.alias("plain")).select(
        F.spark_partition_id().cast("long").alias("run"), F.monotonically_increasing_id().alias("row"), "doc_id",
        F.unhex(F.sha2("plain", 256)).alias("digest"), F.xxhash64("plain").alias("check"),
        F.octet_length("plain").cast("long").alias("bytes"))


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours with an equal key become their last row, with the sum of n. The rows come sorted by key,
    then from worst to best; a key may go on in the next batch."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        table = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
        if not table.num_rows:
            continue
        last = np.ones(table.num_rows, bool)
        last[:-1] = False
        for name in ("run", "digest", "check", "bytes"):
            column = table.column(name).chunk(0)
            if name == "digest":
                column = np.frombuffer(column.buffers()[2], "S32", table.num_rows, _first(column)) \
                    .view(np.uint64).reshape(-1, 4)
                last[:-1] |= (column[1:] != column[:-1]).any(axis=1)
            else:
                column = np.asarray(column)
                last[:-1] |= column[1:] != column[:-1]
        ends = np.flatnonzero(last)
        sums = np.add.reduceat(np.asarray(table.column("n")), np.concatenate(([0], ends[:-1] + 1)))
        columns = [pa.array(sums) if f.name == "n" else table.column(f.name).chunk(0).take(pa.array(ends))
                   for f in table.schema]
        out = pa.RecordBatch.from_arrays(columns, schema=table.schema)
        held = out.slice(out.num_rows - 1)
        if out.num_rows > 1:
            yield out.slice(0, out.num_rows - 1)
    if held is not None:
        yield held


def _first(column: pa.Array) -> int:
    return np.frombuffer(column.buffers()[1], np.int32, column.offset + 1)[column.offset].item()


def _merged(runs: DataFrame, best: str) -> DataFrame:
    better = F.col("doc_id").asc_nulls_first() if best == "largest" else F.col("doc_id").desc_nulls_first()
    order = ["run", "digest", "check", "bytes", better, F.col("row").desc()]
    return runs.sortWithinPartitions(*order).mapInArrow(_merge_sorted, RUN)


def duplicates(docs: DataFrame, best: str = "largest", fan_in: int = 8, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs."""
    if best not in ("largest", "smallest") or fan_in < 2 or fan_in & (fan_in - 1):
        raise ValueError("best is largest or smallest, fan_in a power of two from 2")
    rows = written(_digests(docs, key, text))
    same = ["run", "digest", "check", "bytes"]
    runs = _merged(rows.select(*same, "doc_id", "row", F.lit(1).cast("long").alias("n")), best)
    n_runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    levels: list[DataFrame] = []
    while n_runs > 1 or not levels:
        raised = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("long")).repartition("run", "digest")
        levels.append(runs := written(_merged(raised, best)))
        n_runs = -(-n_runs // fan_in)

    found = levels[-1].select(*same, F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
                              F.col("n").alias("group_size"))
    for level in [*levels[-2::-1], rows]:
        mine = [] if level is not rows else ["doc_id", "row"]
        lower = level.select(F.col("run").alias("low"), *same[1:], *mine).withColumn(
            "run", F.floor(F.col("low") / fan_in).cast("long"))
        found = lower.join(found, same).select(F.col("low").alias("run"), *same[1:], *mine, "keep_id", "keep_row",
                                               "group_size")
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
