"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find.

SuperMinHash (Ertl 2017) gives each element a random permutation of the m places, one place per step; in step j an
element's value at its j-th place is j plus a random fraction, and a place keeps its least value. Since an element's ranks are
correlated, places share the elements evenly and the variance is below MinHash's. A document stops as
soon as no place can get lower: all its places are below the step.

Documents are grouped first by equal word sequence, so copies cost one signature and no pairs. Signatures are cut into
bands; documents with an equal band are candidates. A bucket is worked off in two rounds and without listing all its pairs:

1. every member is compared with the bucket's least document; links found join components,
2. members outside a bucket's main component are compared with some members of that component spread over it,
3. what is outside the main component still is compared with all members of other components.

After that any two members of a bucket are in one component or have been compared: by their set sizes, by sketches of one
bit per place, where agreement within 5 or 6 standard deviations of the similarity asked for passes, and at last by the
full shingle sets, which decide. Most copies join in the first rounds, so the third has few rows to work with; its
pairs are tested inside the join, before a row is made: by the parities of hash bins, whose differing bits never outnumber
the elements that only one of two sets has, so no link is lost; and sets too large for the bins by fine sketches.

Defined results: a document without words has an empty set and is alone; one with fewer than n words has its word sequence as
only shingle; rows with the same id are one node and give a row each; rows with a null id are alone, component null, kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.components import connected_components
from ..session import written
from .words import SPACE, ascii_lower, grams, mixed

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Near:
    words: int = 5
    percent: int = 75
    places: int = 256
    rows: int = 5  # places per band; a pair at 75 percent misses all 51 bands once in a million

    fine: int = 2048  # bins of the parities and places of the fine sketch, which only documents of open buckets get
    few: int = 1024  # sets up to this size are compared by parities, larger ones by fine sketches
    spread: int = 16  # members of a component that stand for it in the second round

    def least_agreeing(self, bits: int, places: int, deviations: float) -> int:
        """Places of two sketches with so many bits each that agree at the similarity asked for, less some deviations."""
        p = self.percent / 100
        p += (1 - p) / 2 ** bits
        return int(places * p - deviations * (places * p * (1 - p)) ** 0.5)


def step_salt(j: int) -> np.uint64:
    return np.uint64(int(_GOLDEN) * (j + 1) % 2**64)


def signatures(elements: np.ndarray, bounds: np.ndarray, m: int, chunk: int = 1 << 15) -> np.ndarray:
    """m values (step << 32 | fraction) for each set of 64-bit elements; all ones for an empty set."""
    n = len(bounds) - 1
    out = np.full((n, m), np.uint64(m) << np.uint64(32), np.uint64)
    owner_all = np.repeat(np.arange(n), np.diff(bounds))
    for at in range(0, len(elements), chunk):
        _improve(out, elements[at:at + chunk], owner_all[at:at + chunk], m)
    out[np.diff(bounds) == 0] = np.uint64(0xFFFFFFFFFFFFFFFF)
    return out


def _improve(out: np.ndarray, elements: np.ndarray, owner: np.ndarray, m: int) -> None:
    flat = out.reshape(-1)
    order: np.ndarray | None = None  # permutation of each active element, from the second step
    for j in range(m):
        if j:
            first, last = owner[0], owner[-1]
            top = (out[first:last + 1].max(axis=1) >> np.uint64(32)).astype(np.int64)
            going = top[owner - first] >= j
            if not going.any():
                return
            if order is None:
                elements, owner, k0 = elements[going], owner[going], place[going]
                order = np.tile(np.arange(m, dtype=np.int16), (len(elements), 1))
                line = np.arange(len(elements))
                order[line, k0] = 0
                order[:, 0] = k0
            elif going.mean() < 0.7:
                elements, owner, order = elements[going], owner[going], order[going]
                line = np.arange(len(elements))
        draw = mixed(elements + step_salt(j))
        low, high = draw & np.uint64(0xFFFFFFFF), draw >> np.uint64(32)
        k = j + ((low * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            place = k
        else:
            place = order[line, k].astype(np.int64)
            order[line, k] = order[:, j]
            order[:, j] = place
        np.minimum.at(flat, owner * m + place, (np.uint64(j) << np.uint64(32)) | high)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each run of ``rows`` places, different for each run."""
    n, m = signature.shape
    parts = signature[:, :m // rows * rows].reshape(n, -1, rows)
    key = np.tile(np.arange(parts.shape[1], dtype=np.uint64), (n, 1))
    for r in range(rows):
        key = mixed(key * _GOLDEN + np.uint64(1)) ^ mixed(parts[:, :, r])
    return mixed(key)


SIGNED = "id long, same binary, n_shingles long, bands array<long>, sketch binary"


def _sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted shingle hashes of each text."""
    flat, bounds = grams(texts, n, whole_when_short=True)
    return [np.unique(flat[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _signed(docs: DataFrame, near: Near) -> DataFrame:
    """id, same, n_shingles, bands and sketch of every row (id, same, plain)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = _sets(part.column(2), near.words)
                size = np.fromiter(map(len, sets), np.int64, len(sets))
                elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                found = signatures(elements, np.concatenate(([0], np.cumsum(size))), near.places)
                keys = bands(found, near.rows).view(np.int64)
                sketch = np.ascontiguousarray((mixed(found) & np.uint64(0xFF)).astype(np.uint8))
                offsets = np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(size),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                     pa.array([row.tobytes() for row in sketch], pa.binary())],
                    ["id", "same", "n_shingles", "bands", "sketch"])

    return docs.mapInArrow(sign, SIGNED)


def _agreeing(pairs: DataFrame, signed: DataFrame, near: Near) -> DataFrame:
    """Pairs (a, b) whose sketches agree often enough and whose set sizes allow the similarity."""
    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, near.places)
                           for i in (2, 3))
            same = (left == right).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array(same >= near.least_agreeing(8, near.places, 6)))

    ends = signed.select("id", "n_shingles", "sketch")
    joined = pairs.join(ends.toDF("a", "na", "sa"), "a").join(ends.toDF("b", "nb", "sb"), "b")
    fitting = joined.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * near.percent)
    return fitting.select("a", "b", "sa", "sb").mapInArrow(agree, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    """Pairs (a, b) whose shingle sets are as similar as asked. Only texts in a pair take part."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                left, right = _sets(part.column(2), near.words), _sets(part.column(3), near.words)
                good = []
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * both >= near.percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(
                    pa.array(good, pa.bool_()))

    joined = (pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb"))
    return joined.mapInArrow(compare, "a long, b long")


def _merge_local(edges: DataFrame) -> DataFrame:
    """Edges of each partition contracted by union-find: every node points to its least known node."""
    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p] if p in parent else p
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = [(x, root(x)) for x in parent]
        nodes = [(x, r) for x, r in nodes if x != r]
        for at in range(0, len(nodes), 50_000):
            some = nodes[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in some], pa.int64()),
                                              pa.array([r for _, r in some], pa.int64())], ["u", "v"])

    return edges.mapInArrow(contract, "u long, v long")


def _components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id and component of every node; edges (u, v)."""
    return connected_components(nodes.select(F.col("id").alias("node")), _merge_local(edges)).toDF("id", "component")


def parities(elements: np.ndarray, bounds: np.ndarray, bins: int) -> np.ndarray:
    """For each set of 64-bit elements, whether each of so many bins has an odd number of them."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    at = owner * bins + (mixed(elements + _GOLDEN) % np.uint64(bins)).astype(np.int64)
    return np.bincount(at, minlength=n * bins).reshape(n, bins) % 2 == 1


def _fine(texts: DataFrame, near: Near) -> DataFrame:
    """id, n, exact and bits, 64 to a column, of every text (id, plain).

    exact: parities, of sets up to near.few. Not exact: a bit of each of many places, of sets that may be similar to one
    above near.few. Sets a little below it have a row of each.
    """
    names = [f"b{i}" for i in range(near.fine // 64)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                sets = _sets(part.column(1), near.words)
                size = np.fromiter(map(len, sets), np.int64, len(sets))
                for exact, some in (True, size <= near.few), (False, size * 100 > near.few * near.percent):
                    if not some.any():
                        continue
                    elements = np.concatenate([x for x, ok in zip(sets, some) if ok])
                    bounds = np.concatenate(([0], np.cumsum(size[some])))
                    bits = (parities(elements, bounds, near.fine) if exact
                            else mixed(signatures(elements, bounds, near.fine)) & np.uint64(1) == 1)
                    packed = np.packbits(bits, axis=1).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).filter(pa.array(some)), pa.array(size[some]),
                         pa.array(np.full(len(packed), exact)), *map(pa.array, packed.T.copy())],
                        ["id", "n", "exact", *names])

    return texts.mapInArrow(sign, "id long, n long, exact boolean, " + ", ".join(f"{c} long" for c in names))


def _may_link(near: Near) -> Column:
    """Whether the sets of two documents, the second one's columns begin with x_, may be as similar as asked."""
    differing = sum(F.bit_count(F.col(f"b{i}").bitwiseXOR(F.col(f"x_b{i}"))) for i in range(near.fine // 64))
    least, most = F.least("n", "x_n"), F.greatest("n", "x_n")
    apart = differing * (100 + near.percent) <= (F.col("n") + F.col("x_n")) * (100 - near.percent)
    fine = (most > near.few) & (differing <= near.fine - near.least_agreeing(1, near.fine, 5))
    return (least * 100 >= most * near.percent) & F.when(F.col("exact"), apart).otherwise(fine)


def _open(shared: DataFrame, components: DataFrame) -> DataFrame:
    """band, id, component and main, the largest component, of the buckets with more than one component."""
    labelled = shared.select("band", "id").join(components, "id")
    sizes = labelled.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                     F.count(F.lit(1)).alias("c")).where("c > 1").select("band", "main")
    return written(labelled.join(main, "band"))


def _joined(nodes: DataFrame, components: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links (a, b)."""
    if links.isEmpty():
        return components
    known = components.where("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v"))
    return written(_components(nodes, links.toDF("u", "v").unionByName(known)))


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a < b").distinct()


def _linked(pairs: DataFrame, signed: DataFrame, texts: DataFrame, near: Near) -> DataFrame:
    return written(_verified(written(_agreeing(pairs, signed, near)), texts, near))


def near_duplicates(docs: DataFrame, near: Near = Near(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    plain = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(F.col(key).cast("long").alias("id"), plain.alias("plain"))
    sequence = F.btrim(F.regexp_replace("plain", SPACE, " "))
    signed = written(_signed(rows.select("id", F.unhex(F.sha2(sequence, 256)).alias("same"), "plain"), near))
    usable = signed.where("n_shingles > 0 AND id IS NOT NULL")
    # copies of a word sequence: the least id stands for them
    classes = written(usable.groupBy("same").agg(F.min("id").alias("class")))
    nodes = classes.select(F.col("class").alias("id")).distinct()

    banded = usable.select("id", "bands").join(nodes, "id", "left_semi").select("id", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("id").alias("leader"), F.max("id").alias("last"))
    shared = written(banded.join(buckets.where("leader < last").select("band", "leader"), "band"))
    members = shared.select("id").distinct()
    texts = written(rows.join(members, "id", "left_semi"))
    known = usable.select("id", "n_shingles", "sketch").join(members, "id", "left_semi")

    stars = shared.where("id > leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    first = written(_components(nodes, _linked(stars, known, texts, near).toDF("u", "v")))

    # some members of each component, spread over it by a hash, for all outside it that share a bucket with it
    around = _open(shared, first).where("component <> main").select("id", "main").distinct()
    standing = first.groupBy(F.col("component").alias("main"), F.pmod(F.xxhash64("id"), F.lit(near.spread)).alias("salt")).agg(
        F.min("id").alias("other"))
    some = _ordered(around.join(standing, "main"), "id", "other").join(stars, ["a", "b"], "left_anti")
    some = written(some)
    second = _joined(nodes, first, _linked(some, known, texts, near))

    # all others, tested by set sizes, parities and fine sketches before a pair is made
    open_rows = _open(shared, second)
    facts = written(_fine(texts.join(open_rows.select("id").distinct(), "id", "left_semi"), near))
    theirs = [c for c in facts.columns if c not in ("id", "exact")]
    placed = open_rows.join(facts, "id")
    other = placed.where("component <> main").select(
        "band", "exact", F.col("id").alias("x"), F.col("component").alias("cx"), *[F.col(c).alias(f"x_{c}") for c in theirs])
    across = other.join(placed, ["band", "exact"]).where(
        (F.col("cx") != F.col("component")) & ((F.col("component") == F.col("main")) | (F.col("x") < F.col("id"))) & _may_link(near))
    rest = _ordered(across, "x", "id").join(stars.unionByName(some), ["a", "b"], "left_anti")
    last = _joined(nodes, second, _linked(rest, known, texts, near))

    of_class = classes.join(last, F.col("class") == F.col("id")).select("same", "component")
    placed = signed.select(F.col("id").alias("doc_id"), "same", "n_shingles").join(of_class, "same", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id")).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
