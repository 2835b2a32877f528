"""Packing documents into sequences by order-preserving dynamic programming.

Documents are put in doc_id order by a range partitioning; each task reads its range as one stream of tokens
and packs it in blocks of ``block_tokens``. In a block the cuts are chosen to minimise

    padding of every window + a penalty for every cut inside a document,

where a cut at a document's end is free, one at a sentence's end cheap and one elsewhere dear. The best start of
the window that ends at a candidate is the minimum of cost + position over the last ``length`` tokens: a monotone
queue gives it in constant time, so a block costs time in proportion to its candidates. Nothing but the
block is held, besides the document that ends it; a document longer than a block is a block of its own.

Defined results: null text counts as empty, an end id alone; documents with the same or a null id follow each other in any
order; an empty table has no pieces.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .tokens import by_bytes, crc32, encoder

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


@dataclass(frozen=True)
class Costs:
    length: int = 2048
    sentence: float = 2.0  # a cut after a sentence costs as much as this many tokens of padding
    inside: float = 24.0  # a cut within a sentence
    longest_gap: int = 64  # without a sentence's end for so long, cuts within it are considered
    block_tokens: int = 1 << 20


def candidates(total: int, documents: np.ndarray, sentences: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, ascending from 0 to total, and the penalty of each."""
    known = np.unique(np.concatenate(([0, total], documents, sentences)))
    gaps = np.diff(known)
    steps = (gaps - 1) // costs.longest_gap
    wide = np.repeat(known[:-1], steps)
    first = np.repeat(np.cumsum(steps) - steps, steps)
    extra = wide + (np.arange(len(wide)) - first + 1) * costs.longest_gap
    places = np.sort(np.concatenate((known, extra)))
    penalty = np.full(len(places), costs.inside)
    penalty[np.searchsorted(places, sentences)] = costs.sentence
    penalty[np.searchsorted(places, documents)] = 0.0
    penalty[0] = penalty[-1] = 0.0
    return places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, length: int) -> np.ndarray:
    """The chain of window ends with the least cost, from 0 to the last place."""
    at, pay = places.tolist(), penalty.tolist()
    back = [0] * len(at)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # cost + position, rising; and the candidate
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][1]] < here - length:
            queue.popleft()
        value, back[j] = queue[0]
        value += length + pay[j]  # the cost so far plus this place: value - here + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [len(at) - 1], len(at) - 1
    while j:
        j = back[j]
        cuts.append(j)
    return places[np.array(cuts[::-1])]


def pack_block(doc_ids: list, ids: np.ndarray, bounds: np.ndarray, sentences: np.ndarray, costs: Costs,
               first_sequence: int) -> tuple[pa.RecordBatch, int]:
    """Pieces of one block and the number of its sequences."""
    places, penalty = candidates(int(bounds[-1]), bounds[1:], sentences, costs)
    cuts = best_cuts(places, penalty, costs.length)
    edges = np.union1d(cuts, bounds)
    start, end = edges[:-1], edges[1:]
    doc = np.searchsorted(bounds, start, "right") - 1
    window = np.searchsorted(cuts, start, "right") - 1
    sums = [crc32(ids[a:b]) for a, b in zip(start.tolist(), end.tolist())]
    arrays = [pa.array(doc_ids, pa.int64()).take(pa.array(doc)), start - bounds[doc], end - start, sums,
              bounds[doc + 1] - bounds[doc], first_sequence + window, start - cuts[window]]
    arrays = [a if isinstance(a, pa.Array) else pa.array(a, pa.int64()) for a in arrays]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SCHEMA.split(", ")]), len(cuts) - 1


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, costs: Costs = Costs(), key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """A row per piece of a document in a sequence. tokenizer: the vocabulary file, at the same path on all machines."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, end_id).encode
        sequence = TaskContext.get().partitionId() << 40
        held: list[tuple] = []
        size = 0

        for batch in batches:
            for part in by_bytes(batch, 1):
                ids, bounds, sentences = encode(pc.fill_null(part.column(1), ""))
                held.append((part.column(0).to_pylist(), ids, bounds, sentences))
                size += len(ids)
                if size >= costs.block_tokens:
                    block, n = _joined(held, costs, sequence)
                    sequence, held, size = sequence + n, [], 0
                    yield block
        if held:
            yield _joined(held, costs, sequence)[0]

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(packed, SCHEMA)


def _joined(held: list[tuple], costs: Costs, sequence: int) -> tuple[pa.RecordBatch, int]:
    """One block out of encoded groups of documents."""
    shift = np.cumsum([0] + [len(h[1]) for h in held])
    bounds = np.concatenate([[0]] + [h[2][1:] + s for h, s in zip(held, shift)])
    sentences = np.concatenate([h[3] + s for h, s in zip(held, shift)])
    return pack_block([d for h in held for d in h[0]], np.concatenate([h[1] for h in held]), bounds, sentences,
                      costs, sequence)
