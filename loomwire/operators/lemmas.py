"""Lemma look-up by a dictionary table (word, lemma)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import tokens_unicode

BUCKETS = 32


def clean_with_lemmas(articles: DataFrame, key: str, text: str, dictionary: DataFrame,
                      stop: Sequence[str], min_length: int = 3) -> DataFrame:
    """(key, text_clean): stop words out, words replaced by lemmas, short lemmas out.

    The dictionary is joined to the distinct words of each article, so a frequent word travels once
    per article, and Spark itself decides from its size whether to broadcast it. Only words that the dictionary
    changes go on from there. An article's changes are held in buckets by hash: a map is searched from its start.
    """
    words = articles.select(F.col(key).alias("_key"), tokens_unicode(text).alias("_words"))
    stop = list(stop)

    def bucket(word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")

    wanted = F.filter(F.array_distinct("_words"), lambda w: ~w.isin(stop))
    lemma = F.lower("lemma")
    changes = F.collect_set(F.struct(bucket(F.col("word")).alias("bucket"), "word", lemma.alias("lemma")))
    pairs = (words.select("_key", F.explode(wanted).alias("word"))
             .join(dictionary.select("word", "lemma").dropDuplicates(["word"]), "word")
             .where(lemma != F.col("word"))
             .groupBy("_key").agg(changes.alias("_changes"))
             .select("_key", F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.map_from_entries(F.transform(
                 F.filter("_changes", lambda c: c["bucket"] == b), lambda c: F.struct(c["word"], c["lemma"])))).alias("_lemmas")))
    kept = F.filter("_words", lambda w: ~w.isin(stop))
    looked_up = F.transform(kept, lambda w: F.coalesce(F.try_element_at(F.get("_lemmas", bucket(w)), w), w))
    long_enough = F.filter(looked_up, lambda w: F.length(w) >= min_length)
    # an article without a key has no words
    return (words.join(pairs, "_key", "left")
            .select(F.col("_key").alias(key),
                    F.when(F.col("_key").isNotNull(), F.array_join(long_enough, " ")).otherwise("").alias("text_clean")))
