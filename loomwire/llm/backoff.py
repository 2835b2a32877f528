"""Language-model scores: stupid backoff (Brants et al. 2007) with counts of the other documents.

Relations: exploded n-grams (block of documents, n-gram, count), count tables partitioned by a slice of the n-gram's
hash, their join, and a sum per document. An n-gram appears once per block of documents and not once per
document, counted beforehand, and the rows of a block and slice travel as one row of packed columns. So no n-gram,
however frequent, has more rows than there are blocks, and the shuffle stays below six bytes per different n-gram of a
block. A block is told of each n-gram how often other blocks have it, which is mostly never.

Every count is reduced by the document's own occurrences: a text is scored by the rest of the corpus. The score of a
word is n(context, word) / n(context) for the longest order seen elsewhere, times ``discount`` for each step down; an
unseen word counts as half an occurrence. A document's score is the mean natural logarithm.

Defined results: a document without words has n_words 0 and a null score; null text counts as empty; rows with the same or a null
id are documents of their own; an empty table gives no rows. N-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import ascii_lower, gram_hashes, split_words, word_hashes


@dataclass(frozen=True)
class Model:
    order: int = 3
    discount: float = 0.4
    block_rows: int = 2048  # documents in a block, about
    slice_grams: int = 4_000_000  # n-grams in a slice of the hash range, about


@dataclass
class Block:
    """The n-grams of a block of texts: one array entry per word, for each order."""

    owner: np.ndarray  # text of each word
    keys: list[np.ndarray]  # per order, hash of the n-gram that ends at the word; 0 where there is none
    bounds: np.ndarray


def block_of(texts: pa.Array, order: int) -> Block:
    flat, bounds = split_words(texts)
    hashes = word_hashes(flat)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(len(flat)) - bounds[owner] if len(flat) else np.zeros(0, np.int64)
    keys = []
    for n in range(1, order + 1):
        key = np.zeros(len(flat), np.uint64)
        key[n - 1:] = gram_hashes(hashes, n) | np.uint64(1)  # 0 stays free
        key[place < n - 1] = 0
        keys.append(key)
    return Block(owner, keys, bounds)


def distinct_grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The sorted n-grams of all orders and their counts."""
    keys = np.concatenate(block.keys)
    return np.unique(keys[keys != 0], return_counts=True)


def slice_bounds(keys: np.ndarray, slices: int) -> np.ndarray:
    """Where each slice of the hash range begins and ends in sorted keys; slices is a power of two."""
    edge = (np.arange(1, slices, dtype=np.uint64) << np.uint64(64 - slices.bit_length() + 1)) if slices > 1 else []
    return np.concatenate(([0], np.searchsorted(keys, np.array(edge, np.uint64)), [len(keys)])).astype(np.int64)


def scores(block: Block, elsewhere: np.ndarray, total: int, discount: float) -> np.ndarray:
    """Mean log score of each text of the block; elsewhere: occurrences of its sorted n-grams in other blocks."""
    n_texts = len(block.bounds) - 1
    sizes = np.diff(block.bounds)
    rest = total - sizes[block.owner]  # words of the other texts
    everything = np.concatenate(block.keys)
    table, at = np.unique(everything, return_inverse=True)
    counts = np.bincount(at, minlength=len(table))
    if len(table) and table[0] == 0:  # no n-gram: occurs nowhere
        elsewhere = np.concatenate(([0], elsewhere))
        counts[0] = 0
    found = []
    for numbers in np.split(at, len(block.keys)):
        # without the text's own occurrences of the n-gram
        _, group, own = np.unique(block.owner * len(table) + numbers, return_inverse=True, return_counts=True)
        found.append(np.maximum(elsewhere[numbers] + counts[numbers] - own[group], 0))
    log = np.zeros(len(block.owner))
    open_words = np.ones(len(log), bool)
    for n in range(len(block.keys), 0, -1):
        if n > 1:
            context = np.zeros(len(log), np.int64)
            context[1:] = found[n - 2][:-1]  # the n-gram's context ends at the word before
            seen = open_words & (found[n - 1] > 0) & (context > 0)
            log[seen] += np.log(found[n - 1][seen] / context[seen])
        else:
            seen = open_words
            log[seen] += np.log(np.maximum(found[0][seen], 0.5) / np.maximum(rest[seen], 1))
        open_words &= ~seen
        log[open_words] += np.log(discount)
    sums = np.bincount(block.owner, log, n_texts)
    with np.errstate(invalid="ignore", divide="ignore"):
        return sums / sizes


ASKED = "block long, slice int, keys binary, counts binary"
TOLD = "block long, slice int, counts binary"


def packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, all lowest bytes, then the next, and compressed: high bytes are 0 in most rows."""
    import zstandard

    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def texts_of(blobs: pa.ChunkedArray) -> pa.Array:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(b.as_py()).decode() for b in blobs], pa.string())


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their steps, which are small where keys are many."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw), dtype=np.uint64)


def backoff_scores(docs: DataFrame, model: Model = Model(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words and score of every document."""
    words = r"[^\x20\x09-\x0D]+"
    sizes = docs.agg(F.count(F.lit(1)), F.sum(F.regexp_count(F.col(text), F.lit(words)))).first()
    n_docs, total = sizes[0], sizes[1] or 0
    n_blocks = max(1, -(-n_docs // model.block_rows))
    slices = 1
    while slices * model.slice_grams < total * model.order:
        slices *= 2
    plain = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), plain.alias("plain"))
    rows = rows.select(F.pmod(F.xxhash64("doc_id", "plain"), F.lit(n_blocks)).alias("block"), "*")

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            blobs = pa.array([pack(t.as_py().encode()) for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), blobs], ["block", "doc_id", "blob"])

    by_block = rows.mapInArrow(shrink, "block long, doc_id long, blob binary").groupBy("block")

    def ask(group: pa.Table) -> pa.Table:
        grams, counts = distinct_grams(block_of(texts_of(group.column("blob")), model.order))
        at = slice_bounds(grams, slices).tolist()
        some = [i for i in range(slices) if at[i] < at[i + 1]]
        number = group.column("block")[0].as_py()
        return pa.Table.from_arrays(
            [pa.array([number] * len(some), pa.int64()), pa.array(some, pa.int32()),
             pa.array([packed_keys(grams[at[i]:at[i + 1]]) for i in some], pa.binary()),
             pa.array([packed(counts[at[i]:at[i + 1]]) for i in some], pa.binary())], ["block", "slice", "keys", "counts"])

    def tell(group: pa.Table) -> pa.Table:
        keys = [unpacked_keys(x.as_py()) for x in group.column("keys")]
        counts = np.concatenate([unpacked(x.as_py()) for x in group.column("counts")]).astype(np.int64)
        table, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(place, counts, len(table)).astype(np.int64)[place]
        ends = np.cumsum([len(k) for k in keys])
        return pa.Table.from_arrays(
            [group.column("block"), group.column("slice"),
             pa.array([packed(x) for x in np.split(sums - counts, ends[:-1])], pa.binary())], ["block", "slice", "counts"])

    def score(texts: pa.Table, told: pa.Table) -> pa.Table:
        block = block_of(texts_of(texts.column("blob")), model.order)
        parts = sorted(zip(told.column("slice").to_pylist(), told.column("counts")), key=lambda p: p[0])
        elsewhere = np.concatenate([unpacked(p.as_py()) for _, p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
        found = scores(block, elsewhere, total, model.discount)
        size = np.diff(block.bounds)
        return pa.Table.from_arrays([texts.column("doc_id").combine_chunks(), pa.array(size, pa.int64()),
                                     pa.array(found, pa.float64(), mask=size == 0)], ["doc_id", "n_words", "score"])

    asked = by_block.applyInArrow(ask, ASKED)
    told = asked.groupBy("slice").applyInArrow(tell, TOLD)
    return by_block.cogroup(told.groupBy("block")).applyInArrow(score, "doc_id long, n_words long, score double")
