"""Explicit schemas of the datasets which the library reads and writes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


ARTICLES = _struct(title=S, summary=S, link=S, matched_keywords=T.ArrayType(S),
                   ingested_at=T.TimestampType(), image_url=S)
ARTICLES_CSV = _struct(title=S, summary=S, link=S, matched_keywords=S, ingested_at=S, image_url=S)
SEED_KEYWORDS = _struct(category=S, keyword=S)
TREND_SCORES = _struct(topic=S, mentions_this_week=L, mentions_prev_week=L, velocity=D, recency=L,
                       source_count=L, rep_headlines=S, velocity_norm=D, recency_norm=D,
                       source_norm=D, trend_score=D, score_prev=D, score_delta=D)
TOPIC_INFO = _struct(Topic=I, Count=L, Name=S, Representation=T.ArrayType(S),
                     Representative_Docs=T.ArrayType(S))
KEYWORD_FREQUENCIES = _struct(keyword=S, count=L)
PRODUCTS = _struct(url=S, designer=S, title=S)
PRODUCT_REPORT = _struct(section=S, metric=S, value=S)

# Columns which the cleaned and the clustered article tables keep when they exist.
CLEAN_COLUMNS = ("title", "summary", "link", "matched_keywords", "tags", "ingested_at", "text_clean")
CLUSTERED_COLUMNS = CLEAN_COLUMNS + ("image_url", "topic")


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail while the plan is built, not after hours of work, when a column is absent."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; found: {', '.join(df.columns)}")
    return df


def keep_columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Those of the wanted columns which exist, in the order of the input."""
    wanted = set(wanted)
    return df.select(*[c for c in df.columns if c in wanted])
