"""Seed keywords found in articles by substring, and the categories they stand for.

One automaton (Aho and Corasick 1975) holds all keywords and finds them in one pass over each text, so the
time per row does not depend on the length of the list, only on what is found. Rows stay whole: no join, no
shuffle, no key, and it works on streams. The seed table is a dimension: it is collected, and every worker holds one
automaton, some hundred bytes per keyword. The rows of a long list that a text has are listed by the workers, as
expressions over constants take about a microsecond each.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..functions.text import constant_strings, or_empty, split_list

_NAMES = ("ord", "category", "keyword")
_NONE = "\x00null"  # stands for a null among constants
_TOGETHER = 64       # texts a worker has as Python objects at a time
_SHORT = 1_000       # seed rows up to which expressions list those found
_PLACES = 500_000    # seed rows found after which a worker hands its texts on


def seed_rows(seed: DataFrame) -> list[Row]:
    """Seed rows (ord, category?, keyword, low) in seed order, rows with a null order first."""
    columns = [c for c in _NAMES if c in seed.columns]
    rows = seed.where(F.col("keyword").isNotNull()).select(*columns, F.lower("keyword").alias("low")).collect()
    return sorted(rows, key=lambda r: (r["ord"] is not None, r["ord"] or 0))


def _is_word(char: str) -> bool:
    return char.isalpha() or char.isnumeric()


def finder(lows: list[str], whole_word: bool) -> Callable[[str], list[int]]:
    """A function from a text to the numbers of the texts of the list in it, which differ from each other."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    always = [i for i, low in enumerate(lows) if not low]
    for i, low in enumerate(lows):
        if low:
            automaton.add_word(low, (i, len(low)))
    automaton.make_automaton()

    def find(text: str) -> list[int]:
        found = set(always)
        if len(automaton):
            for end, (i, size) in automaton.iter(text):
                if i in found:
                    continue
                start = end + 1 - size
                if not whole_word or not (start and _is_word(text[start - 1])
                                          or end + 1 < len(text) and _is_word(text[end + 1])):
                    found.add(i)
        return list(found)

    return find


def _numbered(seeds: list[Row]) -> dict[str, list[int]]:
    """Places of the seed rows by their different keywords."""
    rows_of: dict[str, list[int]] = {}
    for i, r in enumerate(seeds):
        rows_of.setdefault(r["low"], []).append(i)
    return rows_of


def with_seeds(articles: DataFrame, text: Column, seed: DataFrame, whole_word: bool = False) -> DataFrame:
    """articles with ``_seeds``: the seed rows (ord, category, keyword) found in the text.

    A worker returns numbers of different keywords, so what it holds of a batch is bounded by the texts, however often
    the list repeats a keyword. The rows of each keyword come from constants of the plan.
    """
    return _with_rows(articles, text, seed, seed_rows(seed), whole_word)


def _with_rows(articles: DataFrame, text: Column, seed: DataFrame, seeds: list[Row], whole_word: bool) -> DataFrame:
    rows_of = _numbered(seeds)
    lows = list(rows_of)
    kind = seed.schema["ord"].dataType.simpleString() if "ord" in seed.columns else "int"

    @F.arrow_udf("array<int>")
    def numbers(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = finder(lows, whole_word)
        for batch in batches:
            found, ends = array("i"), [0]
            for at in range(0, len(batch), _TOGETHER):
                for text in batch.slice(at, _TOGETHER).to_pylist():
                    found.extend(find(text) if text is not None else ())
                    ends.append(len(found))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(
                pa.int32(), len(found), [None, pa.py_buffer(found)]))

    def constants(name: str) -> Column:
        return constant_strings([_NONE if name not in r or r[name] is None else str(r[name]) for r in seeds])

    def integers(values: Iterable[int]) -> Column:
        return constant_strings([str(v) for v in values]).try_cast("array<int>")

    starts = integers(accumulate(map(len, rows_of.values()), initial=1))
    order = integers(chain.from_iterable(rows_of.values()))

    def places(number: Column) -> Column:
        start = F.get(starts, number)
        return F.slice(order, start, F.get(starts, number + 1) - start)

    def value(name: str, place: Column, kind: str) -> Column:
        return F.nullif(F.get(constants(name), place), F.lit(_NONE)).cast(kind).alias(name)

    found = F.sort_array(F.flatten(F.transform(numbers(text), places)))
    return articles.withColumn("_seeds", F.transform(found, lambda i: F.struct(
        value("ord", i, kind), value("category", i, "string"), value("keyword", i, "string"))))


def keyword_pairs(articles: DataFrame, key: str, text: Column, seed: DataFrame,
                  whole_word: bool = False) -> DataFrame:
    """One row per article and seed row found in it: (key, ord, category, keyword)."""
    columns = [c for c in _NAMES if c in seed.columns]
    found = with_seeds(articles, text, seed, whole_word).select(key, F.explode("_seeds").alias("_seed"))
    return found.select(key, *[f"_seed.{c}" for c in columns])


def _listed_by_workers(articles: DataFrame, text: Column, seeds: list[Row], whole_word: bool) -> DataFrame:
    """articles with matches, a bounded number of which a worker holds whatever the texts and the list repeat."""
    rows_of = _numbered(seeds)
    lows = list(rows_of)
    number = np.empty(len(seeds), np.int32)
    for n, places in enumerate(rows_of.values()):
        number[places] = n
    keywords = pa.array([str(r["keyword"]) for r in seeds], pa.string())
    names = [str(r["category"]) if "category" in r and r["category"] is not None else None for r in seeds]
    kinds = sorted({n for n in names if n is not None})
    place_of = {k: i for i, k in enumerate(kinds)}
    kind = np.array([place_of.get(n, len(kinds)) for n in names], np.int32)
    categories = pa.array(kinds, pa.string())

    def lists(values: pa.Array, places: list[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, places)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), values.take(pa.array(np.concatenate(places))))

    def tags(places: np.ndarray) -> np.ndarray:
        has = np.zeros(len(kinds) + 1, bool)
        has[kind[places]] = True
        return np.flatnonzero(has[:-1])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder(lows, whole_word)

        def whole(batch: pa.RecordBatch, start: int, found: list[np.ndarray]) -> pa.RecordBatch:
            own = batch.slice(start, len(found)).columns[:-1]
            return pa.RecordBatch.from_arrays(
                [*own, lists(keywords, found), lists(categories, [tags(p) for p in found])], out.names)

        for batch in batches:
            start, held, found = 0, 0, []
            for at in range(0, batch.num_rows, _TOGETHER):
                for value in batch.column(batch.num_columns - 1).slice(at, _TOGETHER).to_pylist():
                    has = np.zeros(len(lows), bool)
                    has[find(value) if value is not None else []] = True
                    found.append(np.flatnonzero(has[number]))
                    held += len(found[-1])
                    if held >= _PLACES:
                        yield whole(batch, start, found)
                        start, held, found = start + len(found), 0, []
            if found:
                yield whole(batch, start, found)

    new = ["matched_keywords", "tags"]
    rows = articles.select(*[c for c in articles.columns if c not in new], text.alias("_text"))
    out = StructType(rows.schema.fields[:-1])
    for name in new:
        out.add(name, ArrayType(StringType()))
    return rows.mapInArrow(listed, out).select(*dict.fromkeys([*articles.columns, *new]))


def with_matches(articles: DataFrame, text: Column, seed: DataFrame, whole_word: bool = False) -> DataFrame:
    """Articles with ``matched_keywords`` (seed order, original case, repeats kept) and sorted ``tags``
    (a keyword without category gives none)."""
    seeds = seed_rows(seed)
    if len(seeds) > _SHORT:
        return _listed_by_workers(articles, text, seeds, whole_word)
    return (_with_rows(articles, text, seed, seeds, whole_word)
            .withColumn("matched_keywords", F.transform("_seeds", lambda s: s["keyword"]))
            .withColumn("tags", F.array_sort(F.array_distinct(F.array_compact(
                F.transform("_seeds", lambda s: s["category"])))))
            .drop("_seeds"))


def keyword_frequencies(articles: DataFrame, keywords: str = "matched_keywords") -> DataFrame:
    """(keyword, count), most frequent first; ``keywords`` is an array column or delimited text."""
    column = F.col(keywords)
    if dict(articles.dtypes)[keywords] == "string":
        column = split_list(F.when(or_empty(keywords) != "", column))
    return (articles.select(F.explode(column).alias("keyword"))
            .groupBy("keyword").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "keyword"))
