"""What a topic is about: its terms by class-based TF-IDF, its name and typical documents.

Weighting after Grootendorst (2022), arXiv:2203.05794: tf / topic length x ln(1 + A / f), where A is
the mean topic length and f the term's count over all topics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import each


def _ranked(df: DataFrame, per: str, order: list, n: int) -> DataFrame:
    """First n rows per group; Spark applies the limit before the shuffle as well."""
    rank = F.row_number().over(Window.partitionBy(per).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def topic_sizes(articles: DataFrame) -> DataFrame:
    """(topic, count), largest first."""
    return (articles.groupBy("topic").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "topic"))


def term_weights(docs: DataFrame, topic: str, tokens: str) -> DataFrame:
    """(topic, term, tf, weight) for every term of every topic; documents without a topic take no part.

    The tokens are exploded and shuffled once: all branches filter alike, so they share the counts. Null tokens are no terms.
    """
    counts = (docs.where(F.col(topic).isNotNull()).select(F.col(topic).alias("topic"), F.explode(each(tokens)).alias("term"))
              .where(F.col("term").isNotNull()).groupBy("topic", "term").agg(F.count(F.lit(1)).alias("tf")))
    lengths = counts.groupBy("topic").agg(F.sum("tf").alias("len"))
    totals = counts.groupBy("term").agg(F.sum("tf").alias("total"))
    mean = lengths.agg((F.sum("len") / F.count(F.lit(1))).alias("mean")).scalar()
    # no topic or term is hot any more: counts has one row per topic and term
    return (counts.join(totals, "term").join(lengths, "topic")
            .select("topic", "term", "tf",
                    (F.col("tf") / F.col("len") * F.log1p(mean / F.col("total"))).alias("weight")))


def topic_terms(docs: DataFrame, topic: str, tokens: str, n: int = 10, digits: int = 12) -> DataFrame:
    """(topic, term, weight, rank): the n heaviest terms; equal weights in order of the term."""
    weights = term_weights(docs, topic, tokens)
    # rounding keeps equal weights equal, whatever order they were added up in
    order = [F.desc(F.round("weight", digits)), "term"]
    return _ranked(weights, "topic", order, n).select("topic", "term", "weight", "rank")


def term_lists(terms: DataFrame) -> DataFrame:
    """(topic, terms): the ranked terms as an array."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return terms.groupBy("topic").agg(F.transform(ordered, lambda t: t["term"]).alias("terms"))


def topic_names(lists: DataFrame, n: int = 4) -> DataFrame:
    """(topic, name): the topic's number and its first n terms joined by underscores."""
    return lists.select("topic", F.concat_ws("_", F.col("topic").cast("string"),
                                             F.slice("terms", 1, n)).alias("name"))


def representative_docs(docs: DataFrame, key: str, topic: str, tokens: str, terms: DataFrame,
                        n: int = 3, digits: int = 9) -> DataFrame:
    """(topic, key, score, rank): the n documents which hold most weight of their topic's terms.

    A document's score is the sum of the weights of its topic's terms which occur in it, added in rank order. The
    documents join a table of one row per topic (its terms as a map); Spark broadcasts it when its size allows and
    otherwise splits hot topics at run time. One hash-based intersection per row finds the terms present.
    """
    known = terms.groupBy(F.col("topic").alias("topic")).agg(F.map_from_entries(F.collect_list(F.struct(
        "term", F.struct("rank", "weight")))).alias("_terms"))
    present = F.array_intersect(F.col(tokens), F.map_keys("_terms"))
    ordered = F.array_sort(F.transform(present, lambda t: F.element_at(F.col("_terms"), t)))
    score = F.aggregate(ordered, F.lit(0.0), lambda acc, t: acc + t["weight"])
    scored = (docs.where(F.col(topic).isNotNull())
              .select(F.col(key).alias("_key"), F.col(topic).alias("topic"), tokens)
              .join(known, "topic")
              .select("topic", "_key", F.round(score, digits).alias("score")))
    return _ranked(scored, "topic", [F.desc("score"), "_key"], n).withColumnRenamed("_key", key)
