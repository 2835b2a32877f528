"""Article search: all words of a phrase must occur, hits are put in brackets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.text import highlight, or_empty, search_text


def search_articles(articles: DataFrame, phrases: Iterable[str], keep: Iterable[str] = ("link", "ingested_at"),
                    max_words: int = 2) -> DataFrame:
    """(phrase, title, summary with hits in brackets, *keep) for every phrase and matching article.

    Phrases of no or more than ``max_words`` words are rejected. All phrases are tested in one pass;
    each is a plain filter with constant patterns.
    """
    accepted = {p: p.lower().split() for p in dict.fromkeys(phrases)}
    accepted = {p: words for p, words in accepted.items() if 1 <= len(words) <= max_words}
    keep = [c for c in keep if c in articles.columns]
    if not accepted:
        return articles.where(F.lit(False)).select(
            F.lit("").alias("phrase"), or_empty("title").alias("title"), or_empty("summary").alias("summary"), *keep)
    text = F.col("_text")
    hits = []
    for phrase, words in accepted.items():
        all_in = F.lit(True)
        for word in words:
            all_in = all_in & F.contains(text, F.lit(word))
        hits.append(F.when(all_in, F.struct(F.lit(phrase).alias("phrase"),
                                            highlight("summary", words).alias("summary"))))
    return (articles.withColumn("_text", search_text())
            .select(or_empty("title").alias("title"), *keep, F.explode(F.array_compact(F.array(*hits))).alias("_hit"))
            .select("_hit.phrase", "title", "_hit.summary", *keep))
