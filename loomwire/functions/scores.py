"""Arithmetic of the trend score."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col

# Fixed values of the score.
WEIGHTS = (0.4, 0.3, 0.3)  # velocity, recency, sources
CLIP = 5.0


def velocity(this: Column | str, prev: Column | str) -> Column:
    """Relative change against the previous week."""
    this, prev = _col(this), _col(prev)
    return (this - prev) / F.greatest(F.lit(1), prev)


def recency(this: Column | str, prev: Column | str) -> Column:
    return 2 * _col(this) + _col(prev)


def clip(value: Column | str, bound: float = CLIP) -> Column:
    return F.greatest(F.lit(-bound), F.least(F.lit(bound), _col(value)))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Position between low and high; a constant column gives 0."""
    return F.coalesce((value - low) / F.nullif((high - low).cast("double"), F.lit(0.0)), F.lit(0.0))


def trend_score(velocity_norm: Column | str, recency_norm: Column | str, source_norm: Column | str,
                weights: tuple[float, float, float] = WEIGHTS) -> Column:
    wv, wr, ws = weights
    return (wv * _col(velocity_norm) + wr * _col(recency_norm) + ws * _col(source_norm)) * 100
