"""Token ids of whole texts with a memory of words.

The public word tokenizer never joins characters across ASCII white space, so a text's ids are its words' ids
one after another. A worker encodes each distinct word once; words of letters and closing punctuation share the
ids of the lower-case letters. Tests compare with the tokenizer on whole texts.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import codes, ranges, split_words

# Letters which lower-casing and normalisation treat one by one, then ASCII punctuation without apostrophes.
_PLAIN = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"
_SENTENCE = r"[.!?。][\"')\]”»]*$"
_MEMORY = 500_000  # words, and pieces as many; a full memory is cleared
_TOGETHER = 256  # words in one call of the tokenizer
_KNOWN: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """The encoder of this Python worker."""
    if (path, end_id) not in _KNOWN:
        _KNOWN[path, end_id] = Encoder(path, end_id)
    return _KNOWN[path, end_id]


def _strings(array: pa.Array) -> list[str]:
    """As to_pylist, several times faster."""
    return array.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Texts to ids, each text with end_id behind it.

    Word 0 is the end of a text. A word's ids are those of its pieces, its letters and its closing punctuation, put together
    once when the word is learnt. Pieces outlive words in the memory, as only they need the tokenizer.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        if resize := getattr(self._tokenizer.model, "_resize_cache", None):
            resize(0)  # each word is asked for once
        size = self._tokenizer.get_vocab_size()
        names = (self._tokenizer.id_to_token(i) or "" for i in range(size))
        self._last = np.fromiter((n.endswith("</w>") for n in names), bool, size)
        self._end_id = end_id
        self._clear_pieces()
        self._clear_words()

    def _clear_words(self) -> None:
        self._words: dict[str, int] = {"": 0}
        self._closes = np.array([True])
        self._ids = np.array([self._end_id], np.uint32)
        self._start, self._length = np.array([0]), np.array([1])

    def _clear_pieces(self) -> None:
        self._pieces: dict[str, int] = {"": 0}
        self._piece_ids = np.zeros(0, np.uint32)
        self._piece_start, self._piece_length = np.array([0]), np.array([0])

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _add(self, texts: list[str], ids: np.ndarray, length: np.ndarray) -> None:
        self._pieces.update(zip(texts, range(len(self._piece_start), len(self._piece_start) + len(texts))))
        self._piece_start = np.concatenate((self._piece_start, len(self._piece_ids) + np.cumsum(length) - length))
        self._piece_length = np.concatenate((self._piece_length, length))
        self._piece_ids = np.concatenate((self._piece_ids, ids))

    def _add_each(self, texts: list[str]) -> None:
        if texts:
            parts = self._encode(texts)
            self._add(texts, np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts)))

    def _add_letters(self, texts: list[str]) -> None:
        """Many words of letters in one call: the last piece of a word carries a mark."""
        if not texts:
            return
        blocks = [texts[i:i + _TOGETHER] for i in range(0, len(texts), _TOGETHER)]
        parts = self._encode([" ".join(b) for b in blocks])
        ids = np.concatenate(parts)
        ends = np.flatnonzero(self._last[ids]) + 1
        if all(int(self._last[p].sum()) == len(b) for p, b in zip(parts, blocks)):
            self._add(texts, ids, np.diff(ends, prepend=0))
        else:
            self._add_each(texts)

    def _places(self, texts: pa.Array, add: Callable[[list[str]], None]) -> np.ndarray:
        """The piece of each text; those not known are added."""
        index, distinct = codes(texts)
        distinct = _strings(distinct)
        add([t for t in distinct if t not in self._pieces])
        return np.fromiter(map(self._pieces.__getitem__, distinct), np.int64, len(distinct))[index]

    def _learn(self, fresh: pa.Array) -> None:
        found = pc.extract_regex(fresh, _PLAIN)
        plain = found.is_valid()
        letters, other = np.flatnonzero(plain), np.flatnonzero(pc.invert(plain))
        found = found.filter(plain)
        pairs = np.zeros((len(fresh), 2), np.int64)
        pairs[letters, 0] = self._places(pc.utf8_lower(pc.struct_field(found, "core")), self._add_letters)
        pairs[letters, 1] = self._places(pc.struct_field(found, "tail"), self._add_each)
        pairs[other, 0] = self._places(fresh.take(pa.array(other)), self._add_each)
        length = self._piece_length[pairs.ravel()]
        ids = self._piece_ids[ranges(self._piece_start[pairs.ravel()], length)]
        length = length.reshape(-1, 2).sum(axis=1)
        self._words.update(zip(_strings(fresh), range(len(self._start), len(self._start) + len(fresh))))
        self._start = np.concatenate((self._start, len(self._ids) + np.cumsum(length) - length))
        self._length = np.concatenate((self._length, length))
        self._ids = np.concatenate((self._ids, ids))
        self._closes = np.concatenate((self._closes, np.asarray(pc.match_substring_regex(fresh, _SENTENCE))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids of all texts (uint32), the n+1 bounds of each, and the places after which a sentence ends."""
        if len(self._pieces) > _MEMORY:
            self._clear_pieces()
        if len(self._words) > _MEMORY:
            self._clear_words()
        flat, bounds = split_words(texts)
        index, distinct = codes(flat)
        numbers = np.fromiter(map(self._words.get, _strings(distinct), repeat(-1)), np.int64, len(distinct))
        fresh = np.flatnonzero(numbers < 0)
        if len(fresh):
            numbers[fresh] = np.arange(len(self._start), len(self._start) + len(fresh))
            self._learn(distinct.take(pa.array(fresh)))
        sequence = np.insert(numbers[index], bounds[1:], 0)
        length = self._length[sequence]
        ids = self._ids[ranges(self._start[sequence], length)]
        ends = np.concatenate(([0], np.cumsum(length)))
        return ids, ends[bounds + np.arange(len(bounds))], ends[1:][self._closes[sequence]]


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def by_bytes(batch: pa.RecordBatch, column: int, most: int = 5 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose strings in a column have about ``most`` bytes, or a single row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    total, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end
