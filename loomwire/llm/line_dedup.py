"""Near-duplicate lines across documents by a deletion-neighbourhood join, in DataFrame operations only.

A line is its sequence of words. Two lines are copies when they are equal, or, with ``least_words`` words or more, when
one word is inserted, deleted or replaced. A line goes when an earlier line (by doc_id, then line number) is a copy.

The neighbourhood of a line is the line itself and the line without its i-th word, each as a hashed key. A key equal with
the same i means one word replaced; the whole of a line equal to another's variant means one inserted. Only the
earliest line of each key matters, so variants are aggregated to minima: no pairs within a key are made, and a key
shared by very many lines is combined before the shuffle. Key matches are then verified on the words.

A key adds up the hashes of a line's neighbouring words. Leaving a word out takes two of them away and adds one, so all
variants of a line cost time in proportion to its words. Other lines may have the same neighbours in another order: where
a match fails the test on the words, all lines of its key are tested. Variants are made only for lines that share
their first or last words with another line, which every copy by one word must do: 4 words, and 12 for lines from 27
words on.

Defined results: null texts have no lines; lines without a word are never copies; lines of documents with the same id and line number
count as one place; rows with a null id come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import in_tasks, written
from .words import SPACE

SHORT, LONG = 4, 12  # words at either end which a copy shares
LONG_FROM = 27  # lines of so many words must share LONG of them; two lengths more use both


NO_ID = -1 << 63  # stands for a null id


def _place(doc_id: Column, line: Column) -> Column:
    """Sort key of a line; a decimal keeps minima in hash aggregates."""
    return (F.coalesce(doc_id, F.lit(NO_ID)).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)")
            + line.cast("decimal(11,0)")).cast("decimal(38,0)").alias("place")


def line_words(line: Column) -> Column:
    """The words of a line. Blanks become spaces first: splitting at one character is much faster than by a pattern."""
    for blank in "\t\v\f\r\n":
        line = F.replace(line, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(line, " "), "")


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, line (from 0) and content of every line."""
    return docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.posexplode(F.split(F.col(text), "\n")).alias("line", "content"))


def _distinct_lines(lines: DataFrame) -> DataFrame:
    """The first place of each different line with a word, its number of words and the hashes of its ends."""
    found = lines.select("doc_id", "line", line_words(F.col("content")).alias("w")).where(F.size("w") > 0)
    size = F.size("w")
    # a line of 2 * SHORT - 1 words shares no end with all its copies, but with those that have a word more
    mid, long = (size >= 2 * SHORT - 1) & (size <= LONG_FROM + 1), size >= LONG_FROM

    def end(when: Column, start: int, n: int) -> Column:
        return F.when(when, F.xxhash64(F.slice("w", start, n)))

    ends = (end(mid, 1, SHORT), end(mid, -SHORT, SHORT), end(long, 1, LONG), end(long, -LONG, LONG))
    narrow = found.select(
        F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"), _place(F.col("doc_id"), F.col("line")),
        size.alias("n"), *[c.alias(f"end{i}") for i, c in enumerate(ends)])
    return narrow.groupBy("h1", "h2", "n").agg(F.min("place").alias("place"),
                                               *[F.max(f"end{i}").alias(f"end{i}") for i in range(4)])


def _neighbours(distinct: DataFrame, least_words: int) -> DataFrame:
    """Places of lines that may have a copy by one word: they share an end with another line, or are short."""
    able = distinct.where(F.col("n") >= least_words)
    ends = able.select("place", F.posexplode(F.array(*[f"end{i}" for i in range(4)])).alias("side", "hash")).where(
        "hash IS NOT NULL")
    shared = ends.groupBy("hash", "side").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("hash", "side")
    return (ends.join(in_tasks(shared), ["hash", "side"], "left_semi").select("place")
            .unionByName(able.where(F.col("n") < 2 * SHORT).select("place")).distinct())


MAP_BITS, MAPS = 15, 2048  # bits of one bitmap as a power of two, and the most bitmaps: 8 MB together


def _among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """rows without most of those that have no equal in wanted, a written table of their key.

    A bitmap of the keys' hashes, 16 bits a key and 8 MB at most, goes to all tasks, so rows that the join to follow
    would drop are dropped before its shuffle. Rows of wanted keys all stay; a full bitmap lets more others through.
    """
    key, = wanted.columns
    maps = min(max(wanted.count() * 16 >> MAP_BITS, 1), MAPS)
    place = F.pmod(F.xxhash64(key), F.lit(maps << MAP_BITS))
    at = {"_map": F.shiftright(place, MAP_BITS), "_bit": place.bitwiseAND((1 << MAP_BITS) - 1)}
    bitmaps = wanted.withColumns(at).repartition("_map").groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright("_bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = rows.withColumns(at).join(F.broadcast(bitmaps), "_map")
    return marked.where(F.getbit(byte, F.col("_bit").bitwiseAND(7).cast("int")) == 1).select(*rows.columns)


def _pair(a: Column, b: Column) -> Column:
    """Hash of two neighbouring words, 40 bits so that a line's sum fits; null stands beyond the ends."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))), 24)


def _candidates(lines: DataFrame, distinct: DataFrame, least_words: int) -> DataFrame:
    """id (in the order of places), place, w and sum of the lines whose variants are made."""
    wanted = written(_neighbours(distinct, least_words))
    texts = _among(lines.select(_place(F.col("doc_id"), F.col("line")), "content"), wanted)
    texts = texts.join(in_tasks(wanted), "place").dropDuplicates(["place"])
    ordered = texts.repartitionByRange("place").sortWithinPartitions("place").select(
        F.monotonically_increasing_id().alias("id"), "place", line_words(F.col("content")).alias("w"))
    inner = F.transform("w", lambda x, i: _pair(x, F.get("w", i + 1)))
    total = F.aggregate(inner, _pair(F.lit(None), F.get("w", F.lit(0))), lambda a, x: a + x)
    return written(ordered.select("*", total.alias("total")))


def _variants(candidates: DataFrame) -> DataFrame:
    """id, i, key: the line without its i-th word, and the whole line with i = -1."""
    def without(x: Column, i: Column) -> Column:
        before, after = F.when(i > 0, F.get("w", i - 1)), F.get("w", i + 1)
        return F.struct(i.alias("i"), (F.col("total") - _pair(before, x) - _pair(x, after) + _pair(before, after)).alias("key"))

    whole = F.array(F.struct(F.lit(-1).alias("i"), F.col("total").alias("key")))
    return candidates.select("id", F.size("w").alias("n"), F.inline(F.concat(whole, F.transform("w", without)))).select(
        "id", "i", F.xxhash64("key", F.col("n") - F.when(F.col("i") < 0, 0).otherwise(1)).alias("key"))


def _within_one(a: str, b: str) -> Column:
    """Whether two word arrays are equal or one insertion, deletion or replacement apart."""
    differs = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    at = F.array_position(differs, True).cast("int")  # the first different word, from 1; 0: equal

    def rest(c: str, start: Column) -> Column:
        return F.slice(c, start, F.greatest(F.size(c), F.lit(1)))

    longer = F.size(a) - F.size(b)
    return (at == 0) | F.when(longer == 0, rest(a, at + 1) == rest(b, at + 1)).when(
        longer == 1, rest(a, at + 1) == rest(b, at)).when(longer == -1, rest(a, at) == rest(b, at + 1)).otherwise(False)


def _verified(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pairs (id, first), a written table, with ok: whether the lines are copies."""
    words = _among(candidates.select("id", "w"), written(pairs.select(F.explode(F.array("id", "first")).alias("id")).distinct()))
    both = pairs.join(words, "id").join(words.toDF("first", "w2"), "first")
    return both.select("id", "first", _within_one("w", "w2").alias("ok"))


def _near(lines: DataFrame, distinct: DataFrame, least_words: int) -> DataFrame:
    """place of every different line which has an earlier copy by one word."""
    candidates = _candidates(lines, distinct, least_words)
    variants = _variants(candidates)
    # most keys belong to one line: a count by key leaves few variants to work with
    busy = variants.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    variants_of = written(variants.join(in_tasks(busy), "key", "left_semi"))
    same_place = variants_of.groupBy("key", "i").agg(F.min("id").alias("first"))
    whole = F.min(F.when(F.col("i") < 0, F.col("id"))).alias("whole")
    part = F.min(F.when(F.col("i") >= 0, F.col("id"))).alias("part")
    any_place = variants_of.groupBy("key").agg(whole, part)
    target = F.when(F.col("i") < 0, F.col("part")).otherwise(F.least("first", "whole"))
    shared = same_place.join(any_place, "key").select("key", "i", target.alias("first")).where("first IS NOT NULL")
    matches = written(variants_of.join(shared, ["key", "i"]).where("first < id").select("key", "id", "first"))
    tested = written(_verified(written(matches.select("id", "first").distinct()), candidates))
    good = tested.where("ok").select("id")
    doubtful = tested.where("NOT ok").select("id", "first").join(good, "id", "left_anti")
    if not doubtful.isEmpty():
        bad = matches.join(doubtful, ["id", "first"]).select("key", "id").distinct()
        others = variants_of.select("key", F.col("id").alias("first")).join(bad.select("key").distinct(), "key", "left_semi")
        pairs = bad.join(others.distinct(), "key").where("first < id").select("id", "first").distinct()
        good = good.unionByName(_verified(written(pairs), candidates).where("ok").select("id"))
    return candidates.select("id", "place").join(good.distinct(), "id", "left_semi").select("place")


def line_verdicts(docs: DataFrame, least_words: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id (null as NO_ID), kept: the numbers of the lines that stay, near: those that go as copies by one word.

    Documents without a line that was first somewhere have no row.
    """
    lines = _lines(docs, key, text)
    distinct = written(_distinct_lines(lines))
    near = _near(lines, distinct, least_words).withColumn("goes", F.lit(True))
    doc = F.floor(F.col("place") / (1 << 31))
    first = distinct.select("place").join(near, "place", "left").select(
        doc.cast("long").alias("doc_id"), (F.col("place") - doc.cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)"))
        .cast("int").alias("line"), F.col("goes").isNull().alias("stays"))
    # a group is the lines of one document
    stays = F.sort_array(F.collect_list(F.when(F.col("stays"), F.col("line")))).alias("kept")
    return first.groupBy("doc_id").agg(
        stays, F.sort_array(F.collect_list(F.when(~F.col("stays"), F.col("line")))).alias("near"))


def dedup_lines(docs: DataFrame, least_words: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with all columns; the text keeps only lines that stay and lines without words between them. A text that loses
    all its words becomes empty; a null text stays null."""
    verdict = line_verdicts(docs, least_words, key, text).select("doc_id", "kept")
    # the row as one column, so its names meet none of these
    at = F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc_id")
    rows = docs.select(F.struct(*docs.columns).alias("row"), at, F.split(F.col(text), "\n").alias("parts"))
    joined = rows.join(verdict, "doc_id", "left")
    # parts is used more than once, so Spark keeps it as a column and looks lines up by number
    blank = F.filter(F.transform("parts", lambda x, i: F.when(F.rlike(x, F.lit(f"^({SPACE})?$")), i)),
                     lambda i: i.isNotNull())
    kept = F.coalesce("kept", F.array().cast("array<int>"))
    stays = F.transform(F.array_sort(F.concat(kept, blank)), lambda i: F.get("parts", i))
    result = F.when(F.size(kept) > 0, F.array_join(stays, "\n")).when(F.size("parts") > 0, F.lit(""))
    return joined.select("row", result.alias("result")).select(
        *[F.col("result").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
