"""The report on new products: totals, frequent words, pairs and designers, and all items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.stopwords import PRODUCT
from ..functions.text import drop_words, tokens_regex
from ..operators.counts import top_k, value_counts, word_and_pair_counts
from ..session import written


def _section(number: int, name: str, counts: DataFrame) -> DataFrame:
    """A top list, which has a few dozen rows, as report rows."""
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "first_seen"))
    return counts.select(F.lit(number).alias("section_ord"), rank.cast("long").alias("rank"), F.lit(name).alias("section"),
                         F.col("term").alias("metric"), F.col("count").cast("string").alias("value"))


def with_tokens(products: DataFrame, stop: Sequence[str] = PRODUCT, min_length: int = 3) -> DataFrame:
    return products.withColumn("tokens", drop_words(tokens_regex("title"), stop, min_length))


def product_report(products: DataFrame, order: str, words: int = 20, pairs: int = 20, designers: int = 10,
                   stop: Sequence[str] = PRODUCT) -> DataFrame:
    """(section_ord, rank, section, metric, value) from products (url, designer, title) with an order number.

    Order by section_ord, rank for the report. All items are part of it, so they are not sorted here. Runs one job while
    it is built.
    """
    # titles and designers are taken out of the pages once; all sections read this narrow table
    products = written(products.select(order, "url", "designer", "title"))
    tokens = with_tokens(products, stop)
    total = products.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("section_ord"), F.lit(1).cast("long").alias("rank"), F.lit("summary").alias("section"),
        F.lit("total_items").alias("metric"), F.col("n").cast("string").alias("value"))
    items = products.select(
        F.lit(4).alias("section_ord"), F.col(order).cast("long").alias("rank"), F.lit("items").alias("section"),
        F.concat_ws(" | ", F.coalesce("designer", F.lit("")), F.coalesce("title", F.lit(""))).alias("metric"),
        F.col("url").alias("value"))
    word_counts, pair_counts = word_and_pair_counts(tokens, "tokens", order)
    return (total
            .unionByName(_section(1, "top_words", top_k(word_counts, words)))
            .unionByName(_section(2, "top_bigrams", top_k(pair_counts, pairs)))
            .unionByName(_section(3, "top_designers", top_k(value_counts(products, "designer", order), designers)))
            .unionByName(items))
