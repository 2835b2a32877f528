"""FEAST whitening against a brute-force eigensolver on the same quantised fit list."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomwire.llm import whitening

SF = "/root/testdata/sf0.01"


def brute(rows, k=16):
    """rows: (vec_id, vector or None). The contract, in plain numpy."""
    ok = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    if not ok:
        return {}, None
    lengths = {}
    for _, v in ok:
        lengths[len(v)] = lengths.get(len(v), 0) + 1
    d = max(lengths, key=lambda n: (lengths[n], n))
    ok = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in ok if len(v) == d]
    fit = np.array(sorted({tuple(x) for _, x in ok}), dtype=np.int64)
    n, s = len(fit), fit.sum(axis=0)
    y = n * fit - s
    cov = (y.astype(float).T @ y.astype(float)) / float(n) ** 3
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    keep = e > 1e-12 * np.trace(cov)
    e, u = e[keep], u[:, keep]
    out = {}
    for i, x in ok:
        z = (n * np.array(x) - s) / n
        dev = int(((n * np.array(x, dtype=object) - s) ** 2).sum())
        for c in range(len(e)):
            w = float(z @ u[:, c] / math.sqrt(e[c]))
            out.setdefault((i, c + 1), []).append((n, dev, abs(w), e[c] / np.trace(cov)))
    return out, u


def check(result, expected):
    got = {}
    for r in result:
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert set(got) == set(expected)
    for key, rows in got.items():
        want = expected[key]
        assert len(rows) == len(want)
        for r, (n, dev, w, ex) in zip(sorted(rows, key=lambda r: (r["deviation"], abs(r["whitened"]))), sorted(want)):
            assert r["n"] == n and r["deviation"] == dev
            assert abs(abs(r["whitened"]) - abs(w)) < 1e-6 * max(1, abs(w))
            assert abs(r["explained"] - ex) <= 1e-4 * ex
        assert rows[0]["identity_error"] <= 1e-4


def test_whitening_equals_eigh_on_embeddings(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    expected, _ = brute([(r["vec_id"], r["embedding"]) for r in table])
    result = whitening.whiten(spark.read.parquet(f"{SF}/embeddings.parquet")).collect()
    check(result, expected)
    signs = {}
    for r in result:
        signs.setdefault(r["component"], set()).add(r["vec_id"])
    assert sorted(signs) == list(range(1, 17))


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    base = [[float(c) for c in rng.standard_normal(4)] for _ in range(12)]
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan")] * 4), (103, [float("inf"), 0.0, 0.0, 0.0]),
             (104, []), (105, [1.0, 2.0]), (None, base[0]), (0, base[0]), (3, base[5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("component", F.lit(1)).withColumn("y", F.lit("clash"))
    result = whitening.whiten(df).collect()
    expected, _ = brute([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v])
                         for i, v in rows])
    check(result, expected)
    assert {r["component"] for r in result} == {1, 2, 3, 4}


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty).collect() == []
    one = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<float>")
    assert whitening.whiten(one).collect() == []


@pytest.mark.parametrize("d,k", [(40, 16), (6, 16), (30, 3)])
def test_feast_against_eigh(d, k):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, 2 * d))
    v = a @ a.T
    values, vectors = whitening.feast(v, min(k, d))
    e, u = np.linalg.eigh(v)
    assert np.allclose(values, e[::-1][:min(k, d)], rtol=1e-12)
    assert np.allclose(np.abs((vectors * u[:, ::-1][:, :min(k, d)]).sum(0)), 1, atol=1e-10)
