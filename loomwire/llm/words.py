"""Words, the maximal runs of characters outside U+0020 and U+0009 to U+000D, as columns and as Arrow arrays."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other letter stays as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The array of words of a text; null for null."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch of texts without nulls, one after another, and the n+1 bounds of each text."""
    lists = pc.ascii_split_whitespace(texts)
    offsets, flat = np.asarray(lists.offsets, dtype=np.int64), lists.values
    flat = flat.slice(offsets[0], offsets[-1] - offsets[0])
    full = np.asarray(pc.greater(pc.binary_length(flat), 0))
    before = np.concatenate(([0], np.cumsum(full, dtype=np.int64)))
    return flat.filter(pa.array(full)), before[offsets - offsets[0]]


def codes(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word and the distinct words by number."""
    encoded = flat.dictionary_encode()
    return np.asarray(encoded.indices), encoded.dictionary


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of each 64-bit number (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    import xxhash

    index, distinct = codes(flat)
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    return table[index]


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words, from the words' hashes; depends on their order."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = mixed(out + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k:len(hashes) - n + 1 + k]
    return mixed(out)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def grams(texts: pa.Array, n: int, whole_when_short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs of every text, and the n+1 bounds of each text.

    A text of fewer than n words has none, or its whole word sequence as the only one.
    """
    flat, bounds = split_words(texts)
    hashes, counts = word_hashes(flat), np.diff(bounds)
    everywhere = gram_hashes(hashes, n)
    size = np.maximum(counts - n + 1, 0)
    out = everywhere[ranges(bounds[:-1], size)]
    if whole_when_short and (short := np.flatnonzero((counts > 0) & (counts < n))).size:
        parts = []
        for i in short:
            own = gram_hashes(hashes[bounds[i]:bounds[i + 1]], counts[i])
            parts.append(own[0])
        ends = np.cumsum(size)
        out = np.insert(out, ends[short], np.array(parts, np.uint64))
        size[short] = 1
    return out, np.concatenate(([0], np.cumsum(size)))
