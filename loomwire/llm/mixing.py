"""Mixing sources to target weights over a tree such as domain, language, source.

Budgets go down the tree, each node's split among its children by weight. A child that cannot use its share, as its
leaves hold too few tokens even with all repeats, takes what it can; its shortage goes to its siblings by
weight, and only what no sibling can take is missing at the parent, which is settled the same way a level higher, since a
node's capacity is the sum of its leaves'. The tree has a row per leaf, not per document.

A leaf takes whole epochs as long as its budget lasts, then a prefix of the next epoch: its documents in
the order of a seeded hash, as long as their tokens fit. The prefix of a hot leaf is not found in one task: tokens are
summed per 256th of the hash range, again per 256th of these, and only inside the last level row by row.

All of it is DataFrame operations on integers. Only ids, leaves and counts are shuffled, never texts.

Defined results: null levels are one value of their own; null or empty texts have no tokens and are taken with the first
document after them that fits; rows with the same id follow each other as one unit of order and are each taken by their own
sum; a tree without weights splits evenly; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import written
from .words import words

_WIDE = "decimal(38,0)"


def _settled(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Budgets of children: nodes has the parent columns, name, weight, capacity and the parent's budget.

    Sorted by capacity per weight, the children that cannot use their share come first. A child is full when its
    capacity is at most its share of what those before it leave.
    """
    order = [(F.col("capacity").cast("double") / F.col("weight")).asc(), F.col(name).asc_nulls_first()]
    before = W.partitionBy(*parent).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    all_of = W.partitionBy(*parent)
    wide = lambda c: F.col(c).cast(_WIDE)
    left = F.greatest(wide("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)).cast(_WIDE),
                      F.lit(0).cast(_WIDE))
    weights = F.sum("weight").over(all_of) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rest = nodes.select("*", left.alias("_left"), weights.cast(_WIDE).alias("_weights"))
    full = wide("capacity") * F.col("_weights") <= F.col("_left") * wide("weight")
    marked = rest.select("*", full.alias("_full"))
    # the first child that is not full sets the level for all after it
    after = W.partitionBy(*parent).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    level = F.first(F.when(~F.col("_full"), F.struct("_left", "_weights")), ignorenulls=True).over(after)
    shared = marked.select("*", level.alias("_level"))
    share = F.expr("CAST((_level._left * weight) DIV _level._weights AS BIGINT)")
    return shared.withColumn("budget", F.when(F.col("_level").isNull(), F.col("capacity"))
                             .otherwise(F.least(F.col("capacity"), share))).drop("_left", "_weights", "_full", "_level")


def _key(names: Sequence[str]) -> Column:
    """The path of a node as text; a null level is left out of it."""
    return F.to_json(F.struct(*names)) if names else F.lit("{}")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], share: tuple[int, int],
                 epochs: int) -> DataFrame:
    """levels and tokens of each leaf, with its budget. weights: per level, integer weights of its names; others weigh 1."""
    up, down = share
    leaves = leaves.withColumn("capacity", F.col("tokens") * epochs)
    tree = leaves.agg(F.sum("capacity").alias("capacity"), F.expr(f"(sum(tokens) * {up}) DIV {down}").alias("budget"))
    tree = tree.select(_key([]).alias("_parent"), F.least("budget", "capacity").alias("budget"))
    for depth, level in enumerate(levels):
        weight = F.lit(1)
        for value, number in weights.get(level, {}).items():
            weight = F.when(F.col(level) == value, number).otherwise(weight)
        nodes = leaves.groupBy(_key(levels[:depth]).alias("_parent"), _key(levels[:depth + 1]).alias("_node"), level).agg(
            F.sum("capacity").alias("capacity")).withColumn("weight", weight.cast("long"))
        tree = _settled(nodes.join(tree, "_parent"), ["_parent"], level).select(F.col("_node").alias("_parent"), "budget")
    return leaves.withColumn("_leaf", _key(levels)).join(tree.withColumnRenamed("_parent", "_leaf"), "_leaf")


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]],
        share: tuple[int, int] = (1, 2), epochs: int = 1, seed: int = 0, key: str = "doc_id", text: str = "text",
        tokens: Column | None = None, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """doc_id, the levels, n_tokens and how often each document is taken (copies), all documents.

    levels: name to column, from the root. share: the budget as a fraction of all tokens. tokens: a count per
    document, words if absent. carry: further columns of the result, such as an address of the row.
    """
    names, carry = list(levels), carry or {}
    count = F.coalesce(F.size(words(F.col(text))), F.lit(0)) if tokens is None else tokens
    rows = written(docs.select(
        F.col(key).cast("long").alias("doc_id"), *[c.alias(n) for n, c in levels.items()],
        F.greatest(count, F.lit(0)).cast("long").alias("n_tokens"), *[c.alias(n) for n, c in carry.items()]))
    leaf = _key(names).alias("_leaf")
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, names, weights, share, epochs)
    # whole epochs, and what is left for the prefix of the next; a row per leaf
    plan = written(budgets.select(
        "_leaf", F.when(F.col("tokens") > 0, F.expr("budget DIV tokens")).otherwise(0).cast("long").alias("_whole"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).cast("long").alias("_room")))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_whole").cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    placed = rows.select("*", leaf).join(plan, "_leaf").withColumn("_order", order)
    fits = F.col("_before") + F.col("n_tokens") <= F.col("_room")
    return _placed(placed).select("doc_id", *names, "n_tokens",
                                  (F.col("_whole") + fits.cast("long")).alias("copies"), *carry)


def _placed(rows: DataFrame) -> DataFrame:
    """rows with _before, the tokens of their leaf's documents before them in the seeded order."""
    rows = rows.withColumns({"_a": F.substring("_order", 1, 2), "_b": F.substring("_order", 3, 2)})
    fine = rows.groupBy("_leaf", "_a", "_b").agg(F.sum("n_tokens").alias("_sum"))
    wide = fine.groupBy("_leaf", "_a").agg(F.sum("_sum").alias("_sum"))

    def sum_before(*keys: str, order: list[str], of: str) -> Column:
        window = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(of).over(window), F.lit(0))

    wide = wide.select("_leaf", "_a", sum_before("_leaf", order=["_a"], of="_sum").alias("_w"))
    fine = fine.select("_leaf", "_a", "_b", sum_before("_leaf", "_a", order=["_b"], of="_sum").alias("_f"))
    base = fine.join(wide, ["_leaf", "_a"]).select("_leaf", "_a", "_b", (F.col("_w") + F.col("_f")).alias("_base"))
    own = sum_before("_leaf", "_a", "_b", order=["_order", "doc_id", "n_tokens"], of="n_tokens")
    return rows.join(base, ["_leaf", "_a", "_b"]).withColumn("_before", F.col("_base") + own)
