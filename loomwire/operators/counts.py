"""Word and word pair counts, with the place of first occurrence for ties.

Places are packed into one decimal so that counting stays a hash aggregate: a struct would turn it
into a sort of every token.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import bigrams, each

_GROUP_BITS = 16  # documents, or groups of them, which meet in one window group
_LEVELS = 4       # of such groups: 4 times 16 bits are all non-negative longs


def place(doc_ord: Column, pos: Column) -> Column:
    """Sort key of a position in the corpus, for any document number from 0 and any array position."""
    checked = F.when(doc_ord >= 0, doc_ord).otherwise(F.raise_error(F.lit("document number below 0")).cast("long"))
    return (checked.cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + pos.cast("decimal(11,0)")).cast("decimal(38,0)")


def term_rows(docs: DataFrame, terms: str, doc_ord: str | None = None) -> DataFrame:
    """One row per array element: (term), and its place when a document number is given."""
    if doc_ord is None:
        return docs.select(F.explode(each(terms)).alias("term"))
    rows = docs.select(F.col(doc_ord).cast("long").alias("_doc"), F.posexplode(each(terms)).alias("_pos", "term"))
    return rows.select("term", place(F.col("_doc"), F.col("_pos")).alias("seen"))


def term_counts(docs: DataFrame, terms: str, doc_ord: str | None = None) -> DataFrame:
    """(term, count) of the elements of an array column, and first_seen when documents are numbered."""
    first = [] if doc_ord is None else [F.min("seen").alias("first_seen")]
    return term_rows(docs, terms, doc_ord).groupBy("term").agg(F.count(F.lit(1)).alias("count"), *first)


def value_counts(df: DataFrame, column: str, doc_ord: str | None = None) -> DataFrame:
    """(term, count) of the non-empty values of a column, and first_seen when rows are numbered."""
    values = df.where(F.col(column) != "")
    first = [] if doc_ord is None else [F.min(doc_ord).alias("first_seen")]
    return values.groupBy(F.col(column).alias("term")).agg(F.count(F.lit(1)).alias("count"), *first)


def top_k(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent terms; equal counts in order of first occurrence, else of the term."""
    ties = ["first_seen", "term"] if "first_seen" in counts.columns else ["term"]
    return counts.orderBy(F.desc("count"), *ties).limit(n)


def followed_by(ranges: DataFrame, keep: Sequence[str], levels: int) -> DataFrame:
    """Join each row's last word to the first word of the next row in document order.

    Input: (ord, first, last, *keep), ord unique and not negative. Rows meet in groups of at most
    65,536 neighbouring numbers. A group then acts as one row with its first first word and last
    last word, and the next level joins the groups. No group grows with the data.
    """
    found = []
    level = ranges.select("ord", "first", "last", *keep)
    for depth in range(levels):
        group = level.withColumn("_group", F.shiftright("ord", _GROUP_BITS))
        ordered = group.withColumn("_next", F.lead("first").over(Window.partitionBy("_group").orderBy("ord")))
        found.append(ordered.where(F.col("_next").isNotNull()).select("last", F.col("_next").alias("next"), *keep))
        if depth + 1 < levels:
            # aggregated after the window, whose partitioning by group it inherits
            level = (ordered.groupBy("_group")
                     .agg(F.min_by("first", "ord").alias("first"),
                          F.max_by(F.struct("last", *keep), F.col("ord")).alias("_end"))
                     .select(F.col("_group").alias("ord"), "first", "_end.*"))
    return reduce(DataFrame.unionByName, found)


def pair_counts(docs: DataFrame, tokens: str, doc_ord: str, cross_document: bool = False) -> DataFrame:
    """(term, count, first_seen) of adjacent word pairs.

    With ``cross_document`` the last word of a document and the first word of the next non-empty
    one form a pair too, as if the corpus were one text.
    """
    return _pairs_of(_grouped(docs, tokens, doc_ord, cross_document, words=False), cross_document)


def word_and_pair_counts(docs: DataFrame, tokens: str, doc_ord: str, cross_document: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both counts (term, count, first_seen) from one reading, one explosion and one shuffle of the tokens."""
    grouped = _grouped(docs, tokens, doc_ord, cross_document, words=True)
    words = grouped.where(F.col("kind") == _WORD).select("term", "count", "first_seen")
    return words, _pairs_of(grouped, cross_document)


_WORD, _PAIR, _BORDER = 0, 1, 2


def _grouped(docs: DataFrame, tokens: str, doc_ord: str, cross_document: bool, words: bool) -> DataFrame:
    """(term, border, count, first_seen, ord, kind): words, pairs, and a row per document with its outer words."""
    # only texts are exploded: what a row is follows from its place behind the n - 1 pairs and the n words
    rows = docs.select(F.col(doc_ord).cast("long").alias("_doc"), F.size(tokens).alias("_n"), F.col(tokens).alias("_words"))
    all_words, n, at = F.col("_words"), F.col("_n"), F.col("_at")
    found, kind, pos = [bigrams(all_words)], F.when(at < n - 1, _PAIR), F.when(at < n - 1, at)
    if words:
        found.append(all_words)
        kind, pos = kind.when(at < 2 * n - 1, _WORD), pos.when(at < 2 * n - 1, at - (n - 1))
    if cross_document:
        outer = F.concat(F.element_at(all_words, 1), F.lit(" "), F.element_at(all_words, -1))
        found.append(F.when(n > 0, F.array(outer)).otherwise(F.array()))
    exploded = (rows.select("_doc", "_n", F.posexplode(F.concat(*found)).alias("_at", "term"))
                .select("term", "_doc", kind.otherwise(_BORDER).alias("_kind"),
                        place(F.col("_doc"), pos.otherwise(n - 1).cast("long")).alias("seen"))
                .withColumn("border", F.when(F.col("_kind") == _BORDER, F.col("_doc"))))
    # Uses select on the aggregates max(border) and max(kind): a filter on a key would be pushed below the
    # shuffle, and the text would be read and shuffled once for each use.
    return exploded.groupBy("term", "_kind", "border").agg(
        F.count(F.lit(1)).alias("count"), F.min("seen").alias("first_seen"), F.max("border").alias("ord"),
        F.max("_kind").alias("kind"))


def _pairs_of(grouped: DataFrame, cross_document: bool) -> DataFrame:
    if not cross_document:
        return grouped.where(F.col("kind") == _PAIR).select("term", "count", "first_seen")
    # the filter refers to ord (always true): both branches then keep the same aggregate, max(border) included, and the
    # second one reuses the first one's shuffle instead of reading and shuffling the text again
    inside = grouped.where((F.col("kind") == _PAIR) & (F.coalesce("ord", F.lit(-1)) >= -1)).select(
        "term", "count", "first_seen")
    outer_words = F.split("term", " ")
    ends = grouped.where(F.col("kind") == _BORDER).select(
        "ord", F.get(outer_words, F.lit(0)).alias("first"), F.get(outer_words, F.lit(1)).alias("last"),
        "count", "first_seen")
    across = followed_by(ends, ["count", "first_seen"], _LEVELS).select(
        F.concat("last", F.lit(" "), "next").alias("term"), "count", "first_seen")
    return (inside.unionByName(across).groupBy("term")
            .agg(F.sum("count").alias("count"), F.min("first_seen").alias("first_seen")))
