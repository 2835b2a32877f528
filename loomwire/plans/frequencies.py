"""Frequent words and word pairs of a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.stopwords import ENGLISH
from ..functions.text import drop_words, title_and_summary, tokens_strip
from ..operators.counts import top_k, word_and_pair_counts


def corpus_tokens(articles: DataFrame, doc_ord: str, stop: Sequence[str] = ENGLISH, min_length: int = 3) -> DataFrame:
    """(doc_ord, tokens): content words of title and summary."""
    words = drop_words(tokens_strip(title_and_summary()), stop, min_length)
    return articles.select(doc_ord, words.alias("tokens"))


def frequency_tables(articles: DataFrame, doc_ord: str, n: int = 50, stop: Sequence[str] = ENGLISH,
                     cross_document: bool = True) -> dict[str, DataFrame]:
    """The n most frequent words (Word, Count) and word pairs (Bigram, Count)."""
    tokens = corpus_tokens(articles, doc_ord, stop)
    counted = word_and_pair_counts(tokens, "tokens", doc_ord, cross_document)
    words, pairs = (top_k(counts, n) for counts in counted)
    return {"words": words.selectExpr("term AS Word", "count AS Count"),
            "bigrams": pairs.selectExpr("term AS Bigram", "count AS Count")}
