"""Embedding whitening by FEAST: components of the covariance from a contour integral, not from a full eigensolver.

Spark does the work that grows with the rows: it checks and quantises every vector, keeps each distinct vector once
(the fit list), sums it per dimension, and sums partial Gram matrices of the centred vectors per partition. Then only
a d x d matrix is left, whatever the number of rows. FEAST finds its largest eigenpairs:

1. Inertia counts (Sturm sequences of a Householder tridiagonal form) place an interval that holds exactly the
   top ``components`` eigenvalues, found by bisection.
2. Gauss-Legendre quadrature on a circle around that interval sums the solves of complex shifted systems
   (z I - V) X = Y; the sum projects Y onto the eigenvectors inside.
3. Rayleigh-Ritz on the projected subspace gives the eigenpairs; the step repeats until the residuals are at rounding
   level, and the inertia count of the interval must equal the number found, so none is missed.

Finally every remaining row is projected and scaled in Spark expressions (no Python on that path).

Defined results: rows whose vector is null, empty, or holds a null, NaN or infinite entry are dropped; so are rows whose
length differs from the most common length (ties: the larger). Null ids stay null; repeated rows give rows each, and the
fit list counts a vector once. An empty table gives no rows. Only components with a positive eigenvalue (above 1e-12 of
the trace) are returned, so a fit list of one vector gives no rows. Equal eigenvalues keep an arbitrary basis of their
space. Sign: each component's entry of largest magnitude (first on ties) is positive. Extra columns are not carried, so
their names cannot clash. ``deviation`` is exact 64-bit arithmetic and raises on overflow instead of wrapping.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import written

INF = float("inf")


@dataclass(frozen=True)
class Feast:
    nodes: int = 16  # Gauss-Legendre points on the upper half of the contour
    iterations: int = 30
    tolerance: float = 1e-14  # relative residual of a converged pair
    seed: int = 7


def _valid(v):
    return F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != F.lit(INF)))


def _gram(batches: Iterator[pd.DataFrame], d: int) -> Iterator[pd.DataFrame]:
    """The partial Gram matrix of one partition's centred vectors y = n x - S, as one row."""
    total = np.zeros((d, d))
    for batch in batches:
        if len(batch):
            y = np.stack(batch["y"].to_numpy()).astype(np.float64)
            total += y.T @ y
    yield pd.DataFrame({"g": [total.ravel()]})


def _tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Householder reduction to tridiagonal form (diagonal, off-diagonal); same eigenvalues."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k]
        alpha = -np.copysign(np.linalg.norm(x), x[0] if x[0] else 1.0)
        v = x.copy()
        v[0] -= alpha
        norm = np.linalg.norm(v)
        if norm == 0:
            continue
        v /= norm
        block = a[k + 1:, k:]
        block -= 2 * np.outer(v, v @ block)
        block = a[k:, k + 1:]
        block -= 2 * np.outer(block @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def _below(diag: np.ndarray, off: np.ndarray, sigma: float) -> int:
    """Inertia: the number of eigenvalues below sigma (negative pivots of the LDL' form of T - sigma I)."""
    count, pivot, tiny = 0, 1.0, np.finfo(float).tiny
    for i in range(len(diag)):
        pivot = diag[i] - sigma - (off[i - 1] ** 2 / pivot if i else 0.0)
        if pivot == 0:
            pivot = -tiny
        count += pivot < 0
    return count


def _eigenvalue(diag, off, index: int, lo: float, hi: float) -> float:
    """The index-th smallest eigenvalue (from 0) by bisection on the inertia count."""
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        if _below(diag, off, mid) > index:
            hi = mid
        else:
            lo = mid
    return (lo + hi) / 2


def _interval(v: np.ndarray, k: int) -> tuple[float, float, int]:
    """An interval around the k largest eigenvalues, with the number of eigenvalues inside by inertia."""
    d = len(v)
    diag, off = _tridiagonal(v)
    radius = np.abs(v).sum(axis=1)
    lo, hi = float((np.diag(v) - (radius - np.abs(np.diag(v)))).min()), float(radius.max())
    span = max(hi - lo, abs(hi), 1e-300)
    lo, hi = lo - 1e-3 * span, hi + 1e-3 * span
    top = hi
    if k < d:
        inside = _eigenvalue(diag, off, d - k, lo, hi)
        outside = _eigenvalue(diag, off, d - k - 1, lo, hi)
        bottom = (inside + outside) / 2 if inside > outside else outside - 1e-9 * span
    else:
        bottom = lo
    return bottom, top, _below(diag, off, top) - _below(diag, off, bottom)


def feast(v: np.ndarray, k: int, options: Feast = Feast()) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenpairs of a symmetric matrix (values falling, vectors as columns) by contour integration."""
    d = len(v)
    bottom, top, count = _interval(v, k)
    centre, radius = (bottom + top) / 2, (top - bottom) / 2
    x, w = np.polynomial.legendre.leggauss(options.nodes)
    theta = np.pi / 2 * (1 + x)
    size = min(d, max(count + 8, int(1.5 * count)))
    y = np.random.default_rng(options.seed).standard_normal((d, size))
    scale = max(np.abs(v).max(), 1e-300)
    for _ in range(options.iterations):
        q = np.zeros((d, size))
        for t, weight in zip(theta, w):
            z = centre + radius * np.exp(1j * t)
            q += 0.5 * weight * (radius * np.exp(1j * t) * np.linalg.solve(z * np.eye(d) - v, y)).real
        basis, _ = np.linalg.qr(q)
        values, vectors = np.linalg.eigh(basis.T @ v @ basis)
        ritz = basis @ vectors
        chosen = (values >= bottom) & (values <= top)
        residual = np.linalg.norm(v @ ritz[:, chosen] - ritz[:, chosen] * values[chosen], axis=0)
        y = ritz
        if chosen.sum() == count and (residual <= options.tolerance * scale * d).all():
            break
    if chosen.sum() != count:
        raise ArithmeticError(f"FEAST found {chosen.sum()} eigenvalues where the inertia count says {count}")
    order = np.argsort(-values[chosen], kind="stable")[:k]
    values, vectors = values[chosen][order], ritz[:, chosen][:, order]
    biggest = np.argmax(np.abs(vectors), axis=0)
    vectors *= np.sign(vectors[biggest, np.arange(vectors.shape[1])])
    return values, vectors


def _dot(y, u: np.ndarray):
    terms = F.zip_with(y, F.array(*[F.lit(float(c)) for c in u]), lambda a, b: a * b)
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def whiten(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 16,
           scale: int = 64, offset: int = 1_000_000, options: Feast = Feast()) -> DataFrame:
    """Per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries become x = floor(scale * c) + offset; runs Spark jobs while it is built (the fit).
    """
    spark = embeddings.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    ok = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & _valid(F.col("v")))
    lengths = ok.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    d = lengths[0]["d"]
    rows = written(ok.where(F.size("v") == d).select(
        "vec_id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(offset)).alias("x")))
    fit = written(rows.select("x").distinct())
    sums = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s"), F.count("*").alias("n"))
    found = sorted(sums.collect())
    n = found[0]["n"]
    s = [r["s"] for r in found]
    s_lit = F.array(*[F.lit(int(c)).cast("long") for c in s])
    centred = F.zip_with("x", s_lit, lambda a, b: F.lit(n).cast("long") * a - b)
    parts = fit.select(centred.alias("y")).mapInPandas(lambda it: _gram(it, d), "g array<double>")
    summed = parts.select(F.posexplode("g").alias("i", "g")).groupBy("i").agg(F.sum("g").alias("g")).collect()
    gram = np.zeros(d * d)
    for r in summed:
        gram[r["i"]] = r["g"]
    cov = gram.reshape(d, d) / float(n) ** 3
    cov = (cov + cov.T) / 2
    trace = float(np.trace(cov))
    if trace <= 0:
        return spark.createDataFrame([], schema)
    values, vectors = feast(cov, min(components, d), options)
    keep = values > 1e-12 * trace
    values, vectors = values[keep], vectors[:, keep]
    if not len(values):
        return spark.createDataFrame([], schema)
    y = F.transform(centred, lambda c: c.cast("double") / F.lit(float(n)))
    scored = F.array(*[F.struct(F.lit(i + 1).alias("component"), (_dot(F.col("y"), vectors[:, i]) / float(np.sqrt(e)))
                                .alias("whitened"), F.lit(float(e / trace)).alias("explained"))
                       for i, e in enumerate(values)])
    k = len(values)
    on_fit = fit.select(y.alias("y")).select(F.explode(scored).alias("p")).select("p.*")
    means = on_fit.groupBy().pivot("component", list(range(1, k + 1))).agg(F.avg("whitened")).collect()[0]
    wide = fit.select(y.alias("y")).select(*[(_dot(F.col("y"), vectors[:, i]) / float(np.sqrt(values[i]))
                                              - F.lit(float(means[str(i + 1)]))).alias(f"w{i}") for i in range(k)])
    products = wide.agg(*[(F.sum(F.col(f"w{a}") * F.col(f"w{b}")) / F.lit(float(n))).alias(f"c{a}_{b}")
                          for a in range(k) for b in range(a, k)]).collect()[0]
    error = max(abs(products[f"c{a}_{b}"] - (1.0 if a == b else 0.0)) for a in range(k) for b in range(a, k))
    deviation = F.aggregate(centred, F.lit(0).cast("long"), lambda acc, c: acc + c * c)
    return rows.select("vec_id", deviation.alias("deviation"), y.alias("y")).select(
        "vec_id", "deviation", F.explode(scored).alias("p")).select(
        "vec_id", F.col("p.component").cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "p.whitened", "p.explained", F.lit(float(error)).alias("identity_error"))
