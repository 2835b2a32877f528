"""Language identification by nearest centroids: TF-IDF vectors of character n-grams, several centroids a language.

Every text, whole, becomes a vector: letters only (a-z and code points from U+00C0 on but a few blocks of signs;
other characters are word breaks), lower-cased, each word padded by a space, character 1- to 3-grams hashed into ``dims`` buckets, weights 1 + log(tf) times the inverse document
frequency, L2-normalised. The fit learns only from rows marked for training (non-null label, ``train`` true):

1. one pass: document frequencies, one dense partial per partition, summed by Spark, and seeds of ``clusters``
   centroids a language: the mean 1 + log(tf) vector of the rows with crc32(id) mod k equal to the cluster;
2. ``rounds`` of k-means on TF-IDF vectors, each a pass that assigns a row to the nearest centroid of its own
   language by cosine and sums per (language, cluster);
   rows farther than ``reject`` in cosine distance from every centroid of their language leave the update (outliers,
   junk, wrong labels);
3. prediction: the nearest centroid over all languages by cosine. ``score`` is that cosine (0 to 1); ``rejected`` says
   that it lies below 1 - ``reject`` (the prediction is still the nearest language).

Each pass streams the rows through Python in slices of about 5 MB; only centroid sums (languages x clusters x dims)
leave a task, and only those and the inverse frequencies (dims) reach the driver and the tasks. The number of labels is
checked against ``most_labels``, which bounds what is broadcast.

Defined results: a null text or one without a letter gets ``und`` and score 0; a null id is never learned from
(held_out null); ties go to the smaller label; repeated rows are learned from each time and predicted alike; without any
labelled training row every prediction is ``und``; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tokens import by_bytes

# Signs among the code points from U+00C0 on (multiplication and division signs, general punctuation to
# miscellaneous symbols and arrows, CJK symbols and punctuation, variation selectors to specials)
NOT_LETTER_BLOCKS = ((0xD7, 0xD7), (0xF7, 0xF7), (0x2000, 0x2BFF), (0x3000, 0x303F), (0xFE00, 0xFE0F),
                     (0xFFF0, 0xFFFF))
PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    dims: int = 1 << 13  # a power of two
    clusters: int = 4
    rounds: int = 2
    reject: float = 0.9
    most_labels: int = 256


def letter_mask(c: np.ndarray) -> np.ndarray:
    """Letters among lower-cased code points: a-z, and from U+00C0 on all but the signs listed in NOT_LETTER_BLOCKS."""
    keep = ((c >= 97) & (c <= 122)) | (c >= 0xC0)
    for lo, hi in NOT_LETTER_BLOCKS:
        keep &= (c < lo) | (c > hi)
    return keep


def grams(text: str | None, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the character 1- to 3-grams of a text's letters; other characters are word breaks."""
    c = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    letter = letter_mask(c)
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.float64)
    c = np.where(letter, c, np.uint64(32))
    parts = [c[letter]]
    two = c[:-1] * np.uint64(1 << 21) + c[1:]
    parts.append(two[letter[:-1] | letter[1:]] | np.uint64(1 << 62))
    three = (c[:-2] * np.uint64(1 << 21) + c[1:-1]) * np.uint64(1 << 21) + c[2:]
    parts.append(three[letter[1:-1]] ^ np.uint64(1 << 63))
    shift = np.uint64(64 - (dims.bit_length() - 1))
    counts = np.zeros(dims, np.int64)
    with np.errstate(over="ignore"):
        for part in parts:
            counts += np.bincount(((part * PRIME) >> shift).view(np.int64), minlength=dims)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets].astype(np.float64)


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    buckets, counts = grams(text, len(idf))
    weights = (1 + np.log(counts)) * idf[buckets]
    norm = np.linalg.norm(weights)
    return buckets, weights / norm if norm else weights


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of batches whose first column is the text, in slices of about 5 MB of text."""
    for batch in batches:
        for part in by_bytes(batch, 0):
            yield from part.to_pylist()


def _first(batches, dims: int, k: int):
    """Document frequencies (label null; the last place holds the number of rows) and, per (label, crc32(id) mod k),
    sums of L2-normalised 1 + log(tf) vectors, which seed the clusters; for this partition."""
    df = np.zeros(dims + 1)
    sums: dict = {}
    for row in _rows(batches):
        buckets, counts = grams(row["text"], dims)
        df[buckets] += 1
        df[dims] += 1
        if len(buckets):
            weights = 1 + np.log(counts)
            total = sums.setdefault((row["label"], row["seed"] % k), np.zeros(dims + 1))
            total[buckets] += weights / np.linalg.norm(weights)
    keys = list(sums)
    yield pa.RecordBatch.from_pydict({"label": [None, *[a for a, _ in keys]], "cluster": [-1, *[b for _, b in keys]],
                                      "v": [df.tolist(), *[sums[key].tolist() for key in keys]]})


def _sums(batches, idf: np.ndarray, centroids: dict, reject: float):
    """Per (label, cluster): the sum of member vectors (k-means step), for this partition."""
    sums: dict = {}
    for row in _rows(batches):
        buckets, weights = vector(row["text"], idf)
        if not len(buckets):
            continue
        label = row["label"]
        if label not in centroids:
            continue
        cosine = centroids[label][:, buckets] @ weights
        cluster = int(np.argmax(cosine))
        if 1 - cosine[cluster] > reject:
            continue
        sums.setdefault((label, cluster), np.zeros(len(idf)))[buckets] += weights
    keys = list(sums)
    yield pa.RecordBatch.from_pydict({"label": [a for a, _ in keys], "cluster": [b for _, b in keys],
                                      "v": [sums[key].tolist() for key in keys]})


def _predict(batches, idf: np.ndarray, labels: list, means: np.ndarray, owner: np.ndarray, reject: float):
    for batch in batches:
        for part in by_bytes(batch, 0):
            out = {"key": part.column(1), "held_out": part.column(2), "lang_pred": [], "score": [], "rejected": []}
            for row in part.to_pylist():
                buckets, weights = vector(row["text"], idf)
                if not len(buckets) or not labels or not row["lettered"]:
                    out["lang_pred"].append("und")
                    out["score"].append(0.0)
                    out["rejected"].append(None)
                    continue
                cosine = means[:, buckets] @ weights
                best = int(np.argmax(cosine))
                out["lang_pred"].append(labels[owner[best]])
                out["score"].append(float(min(max(cosine[best], 0.0), 1.0)))
                out["rejected"].append(bool(1 - cosine[best] > reject))
            yield pa.RecordBatch.from_arrays(
                [out["key"], out["held_out"], pa.array(out["lang_pred"], pa.string()),
                 pa.array(out["score"], pa.float64()), pa.array(out["rejected"], pa.bool_())],
                names=["key", "held_out", "lang_pred", "score", "rejected"])


def _summed(parts: DataFrame) -> list:
    """Sums of the per-partition arrays by (label, cluster); rows of dims numbers, combined before the shuffle."""
    return (parts.select("label", "cluster", F.posexplode("v").alias("i", "x"))
            .groupBy("label", "cluster", "i").agg(F.sum("x").alias("x")).collect())


def _centroids(summed: list, model: Model) -> dict:
    """Unit centroids by label from summed rows (label, cluster, i, x); at most most_labels labels."""
    groups: dict = {}
    for r in summed:
        groups.setdefault((r["label"], r["cluster"]), np.zeros(model.dims + 1))[r["i"]] = r["x"]
    labels = sorted({a for a, _ in groups})
    if len(labels) > model.most_labels:
        raise ValueError(f"{len(labels)} labels, more than most_labels={model.most_labels}")
    found = {}
    for label in labels:
        means = [groups[key][:model.dims] for key in sorted(groups) if key[0] == label]
        found[label] = np.array([m / (np.linalg.norm(m) or 1) for m in means])
    return found


def identify(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", train=None,
             model: Model = Model()) -> DataFrame:
    """Per row: the key, held_out, lang_pred, score and rejected. Runs Spark jobs while it is built (the fit).

    ``train`` is a boolean Column of the rows that may be learned from; by default those whose crc32(key as text)
    mod 4 is not 2.
    """
    if model.dims & (model.dims - 1):
        raise ValueError("dims must be a power of two")
    rest = F.crc32(F.col(key).cast("string").cast("binary")) % 4
    train = rest != 2 if train is None else train
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"),
                       F.col(label).cast("string").alias("label"), train.alias("train"), (rest == 2).alias("held_out"),
                       F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("seed"))
    learn = rows.where(F.col("train") & F.col("label").isNotNull()).select("label", "text", "seed")
    schema = "label string, cluster long, v array<double>"
    first = _summed(learn.select("text", "label", "seed").mapInArrow(
        lambda it: _first(it, model.dims, model.clusters), schema))
    df = np.zeros(model.dims + 1)
    for r in first:
        if r["label"] is None:
            df[r["i"]] = r["x"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    centroids = _centroids([r for r in first if r["label"] is not None], model)
    for _ in range(model.rounds if centroids else 0):
        # a label whose rows were all rejected keeps its centroids
        centroids = centroids | _centroids(_summed(learn.select("text", "label", "seed").mapInArrow(
            lambda it, c=centroids: _sums(it, idf, c, model.reject), schema)), model)
    labels = sorted(centroids)
    owner, means = [], []
    for i, lab in enumerate(labels):
        for m in centroids[lab]:
            owner.append(i)
            means.append(m)
    means = np.array(means) if means else np.zeros((0, model.dims))
    owner = np.array(owner, dtype=np.int64)
    kind = rows.schema["key"].dataType.simpleString()
    # a text without a letter of any script (Unicode class L) is und, whatever its n-grams
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return rows.select("text", "key", "held_out", lettered.alias("lettered")).mapInArrow(
        lambda it: _predict(it, idf, labels, means, owner, model.reject),
        f"key {kind}, held_out boolean, lang_pred string, score double, rejected boolean").withColumnRenamed("key", key)
