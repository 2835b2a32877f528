"""Quality rules by compression: zstandard ratios of whole texts and of fixed chunks must lie in a band.

Repetitive text compresses too well, random text hardly at all. Short texts compress less, so the limits
depend on the length in bytes. Word and line counts of the usual base rules come along.
One pass over the rows without a shuffle.

Defined results: a null text counts as no text (all counts 0, base_failed); repeated rows give a row each; null ids
stay null. Texts of any length are read whole, chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .words import codes, split_words

# (below this many bytes, lowest ratio, highest ratio) of whole texts
BANDS = ((256, 0.8, 2.6), (512, 0.95, 2.8), (1024, 1.1, 3.0), (4096, 1.2, 3.4), (16384, 1.4, 3.8), (None, 1.5, 4.5))
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    bands: tuple = BANDS
    chunk_bytes: int = 4096
    chunk_band: tuple[float, float] = (1.3, 3.6)
    least_chunk: int = 2048  # a shorter last chunk counts only in the whole text
    bad_chunk_share: float = 0.34  # more bad chunks than this reject the text
    level: int = 3
    least_words: int = 20
    repeat_percent: int = 30


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_bytes long, ratio double, n_chunks long, n_bad_chunks long")


def repeated_words(index: np.ndarray, window: int = WINDOW) -> int:
    """Words inside a window of consecutive words that occurs at least twice; index: a number for each word."""
    if len(index) <= window:
        return 0
    with np.errstate(over="ignore"):
        sums = np.zeros(len(index) - window + 1, np.uint64)
        for k in range(window):
            sums = sums * np.uint64(0x9E3779B97F4A7C15) + index[k:len(index) - window + 1 + k].astype(np.uint64)
    if len(np.unique(sums)) == len(sums):
        return 0  # equal windows have equal sums
    # exact: numbers for windows of 1, 2, 4, ... words, each from two halves
    names, step = np.unique(index, return_inverse=True)[1], 1
    while step < window:
        step = min(step, window - step)
        names = np.unique(names[:-step] * (int(names.max()) + 1) + names[step:], return_inverse=True)[1]
        step = len(index) - len(names) + 1
    double = np.bincount(names)[names] > 1
    edge = np.zeros(len(index) + 1, np.int64)
    starts = np.flatnonzero(double)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word which equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _ratios(raw: bytes, compressor, limits: Limits) -> tuple[float, int, int, bool]:
    if not raw:
        return 0.0, 0, 0, False
    ratio = len(raw) / len(compressor.compress(raw))
    low, high = next((lo, hi) for below, lo, hi in limits.bands if below is None or len(raw) < below)
    size, view = limits.chunk_bytes, memoryview(raw)
    chunks = [view[i:i + size] for i in range(0, len(raw), size) if len(raw) - i >= min(size, limits.least_chunk)]
    bad = 0
    for c in chunks:
        r = len(c) / len(compressor.compress(c))
        bad += not limits.chunk_band[0] <= r <= limits.chunk_band[1]
    good = low <= ratio <= high and bad <= limits.bad_chunk_share * len(chunks)
    return ratio, len(chunks), bad, good


def _batch(ids: pa.Array, texts: pa.Array, compressor, limits: Limits) -> pa.RecordBatch:
    texts = pc.fill_null(texts, "")
    flat, bounds = split_words(texts)
    n_words = np.diff(bounds)
    lengths = np.concatenate(([0], np.cumsum(np.asarray(pc.utf8_length(flat)), dtype=np.int64)))
    index, _ = codes(flat)
    symbols = pc.count_substring_regex(texts, SYMBOLS)
    columns: list[list] = [[], [], [], [], [], [], [], []]
    for i, text in enumerate(texts.to_pylist()):
        repeat = repeated_words(index[bounds[i]:bounds[i + 1]])
        failed = bool(n_words[i] < limits.least_words or 100 * repeat > limits.repeat_percent * n_words[i])
        raw = text.encode()
        ratio, chunks, bad, good = _ratios(raw, compressor, limits)
        for column, value in zip(columns, (repeated_lines(text), repeat, failed, good and not failed, len(raw),
                                           ratio, chunks, bad)):
            column.append(value)
    arrays = [ids, pa.array(n_words, pa.int64()), pa.array(lengths[bounds[1:]] - lengths[bounds[:-1]], pa.int64()),
              symbols.cast(pa.int64())]
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
    arrays += [pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SCHEMA.split(", ")])


def quality(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, ratios and the verdict ``kept`` of every document."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=limits.level)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield _batch(part.column(0), part.column(1), compressor, limits)

    narrow = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    return narrow.mapInArrow(measure, SCHEMA)


def keep_good(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text is kept."""
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=limits.level)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                number = pa.nulls(part.num_rows, pa.int64())
                verdict = _batch(number, part.column(part.schema.get_field_index(text)), compressor, limits)
                yield part.filter(verdict.column(7))

    return docs.mapInArrow(select, docs.schema)
