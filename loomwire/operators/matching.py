"""Topic identity between runs: new topics take the ids of old topics by a maximum-weight one-to-one matching.

The weight of (new topic, old topic) is the number of documents they share, from one join on the document key and one
aggregate (combined before the shuffle). The matching is Bertsekas' auction: each round, every new topic without an
old one bids for the old topic of largest value (shared documents less its price) by the difference to its second
best (or to staying unmatched, worth 0) plus epsilon = 1 / (new topics + 1); each old topic goes to its highest bid
(ties: the smaller new id) and its former holder bids again. With whole weights this epsilon gives a matching of
largest total weight. A new topic for which every old one costs more than it shares leaves the auction unmatched.
Each round is a few joins and aggregates on the weight table, whose size is bounded by pairs of topics that share a
document, not by documents.

Rules: a matched new topic takes the old id (shuffled numbers are restored); of a split, the part that shares most
keeps the id (the matching decides) and the others are new; of a merge, the new topic keeps one old id and the other
ids are retired; unmatched new topics get ids after the largest old id, by size (descending) then least document key;
outliers (-1) and null topics are never matched and stay as they are. Documents in only one run do not weigh.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import written

OUTLIER = -1


def topic_weights(old: DataFrame, new: DataFrame, key: str, topic: str = "topic") -> DataFrame:
    """(new, old, w): shared documents of each pair of topics that share any."""
    a = old.where(F.col(topic).isNotNull() & (F.col(topic) != OUTLIER)).select(
        key, F.col(topic).cast("long").alias("old"))
    b = new.where(F.col(topic).isNotNull() & (F.col(topic) != OUTLIER)).select(
        key, F.col(topic).cast("long").alias("new"))
    return a.join(b, key).groupBy("new", "old").agg(F.count("*").alias("w"))


def auction(weights: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """(new, old): a matching of largest total weight; new topics without a match are absent."""
    spark = weights.sparkSession
    weights = written(weights)
    bidders = weights.select("new").distinct().count()
    eps = 1.0 / (bidders + 1)
    owners = spark.createDataFrame([], "old long, new long, price double")
    prices = weights.select("old").distinct().select("old", F.lit(0.0).alias("price"))
    out = spark.createDataFrame([], "new long")
    for _ in range(max_rounds):
        held = owners.select("new")
        free = weights.join(held, "new", "left_anti").join(out, "new", "left_anti")
        values = free.join(prices, "old").select("new", "old", (F.col("w") - F.col("price")).alias("v"))
        ranked = values.groupBy("new").agg(
            F.slice(F.array_sort(F.collect_list(F.struct((-F.col("v")).alias("nv"), F.col("old").alias("old")))), 1, 2)
            .alias("top"))
        bids = written(ranked.select(
            "new", F.get("top", 0)["old"].alias("old"), (-F.get("top", 0)["nv"]).alias("v1"),
            F.greatest(F.coalesce(-F.get("top", 1)["nv"], F.lit(0.0)), F.lit(0.0)).alias("v2")))
        if not bids.limit(1).count():
            break
        out = written(out.unionByName(bids.where(F.col("v1") <= 0).select("new")))
        offers = bids.where(F.col("v1") > 0).join(prices, "old").select(
            "old", "new", (F.col("price") + F.col("v1") - F.col("v2") + F.lit(eps)).alias("bid"))
        won = offers.groupBy("old").agg(F.max(F.struct("bid", (-F.col("new")).alias("nn"))).alias("b")).select(
            "old", (-F.col("b.nn")).alias("new"), F.col("b.bid").alias("price"))
        owners = written(owners.join(won.select("old"), "old", "left_anti").unionByName(won))
        prices = written(prices.join(won.select("old"), "old", "left_anti").unionByName(won.select("old", "price")))
    else:
        raise RuntimeError(f"auction not settled after {max_rounds} rounds")
    return owners.select("new", "old")


def match_topics(old: DataFrame, new: DataFrame, key: str, topic: str = "topic") -> DataFrame:
    """The new run's rows with ``topic`` renamed to the matched old ids and ``fresh_topic`` the id it had."""
    pairs = auction(topic_weights(old, new, key, topic))
    largest = old.agg(F.max(F.when(F.col(topic) != OUTLIER, F.col(topic)))).first()[0]
    base = -1 if largest is None else int(largest)
    sizes = (new.where(F.col(topic).isNotNull() & (F.col(topic) != OUTLIER))
             .groupBy(F.col(topic).cast("long").alias("new")).agg(F.count("*").alias("n"), F.min(key).alias("first"))
             .join(pairs, "new", "left_anti"))
    # one row per unmatched topic
    fresh = sizes.select("new", (F.lit(base) + F.row_number().over(
        Window.orderBy(F.desc("n"), F.col("first"), F.col("new")))).alias("old"))
    names = pairs.unionByName(fresh)
    kind = new.schema[topic].dataType
    # the names have one row per topic; the rows stay where they are and take them by a join on the topic
    return (new.withColumnRenamed(topic, "fresh_topic")
            .join(names.withColumnRenamed("new", "_fresh"), F.col("fresh_topic").cast("long") == F.col("_fresh"), "left")
            .withColumn(topic, F.coalesce(F.col("old"), F.col("fresh_topic").cast("long")).cast(kind))
            .drop("old", "_fresh"))
