"""Batch search through q-gram postings against plain substring tests."""

import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from compare import connect, difference
import __spark_entry__ as entry
from loomwire.operators import qgram_search
from loomwire.operators.qgram_search import search_terms


def test_ten_thousand_terms_equal_contains(spark):
    texts = [t.lower() for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
             if t][:60]
    rng = random.Random(3)
    terms = set()
    while len(terms) < 10_000:
        t = rng.choice(texts)
        start = rng.randrange(len(t))
        terms.add(t[start:start + rng.choice([1, 2, 3, 4, 6, 9, 14])] if rng.random() < 0.8 else
                  "".join(rng.choice("abcxyz é") for _ in range(rng.randint(1, 5))))
    terms = sorted(terms)
    docs = spark.createDataFrame(list(enumerate(texts)) + [(999, None), (1000, "")], "id long, text string")
    table = spark.createDataFrame([(i, t) for i, t in enumerate(terms)] + [(-1, None), (-2, "")], "tid long, term string")
    got = {(r["tid"], r["id"]) for r in search_terms(docs, "id", "text", table, "tid", "term").collect()}
    want = {(i, d) for i, t in enumerate(terms) for d, x in enumerate(texts) if t in x}
    assert got == want


def test_repeated_terms_and_texts_end(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "xab"), (2, "b")], "id long, text string")
    terms = spark.createDataFrame([(1, "b"), (1, "b"), (2, "ab"), (3, "abc"), (4, "c")], "tid long, term string")
    got = sorted((r["tid"], r["id"]) for r in search_terms(docs, "id", "text", terms, "tid", "term").collect())
    assert got == sorted([(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1)])


def test_registered_query_equals_sql_on_sf001(spark):
    sf = "/root/testdata/sf0.01"
    query = entry.queries()["search_term_table"](spark, sf)
    assert difference(query, connect(sf), entry.oracle_sql()["search_term_table"]) is None


def test_postings_and_hits_stay_in_the_tasks(spark, monkeypatch):
    """Postings of all texts were written and candidates shuffled, many times the texts' size."""
    stored, write = [], qgram_search.written
    monkeypatch.setattr(qgram_search, "written", lambda df: stored.append(df.columns) or write(df))
    monkeypatch.setattr(qgram_search, "_TERMS", 4)
    texts = [(1, "abcde"), (2, "xabc"), (3, None), (4, "bé a"), (None, "abc")]
    docs = spark.createDataFrame(texts, "id long, text string")
    words = ["a", "ab", "abc", "abcd", "bcde", "xabc", "xab ", "bé a", "é", "zz", "abce", None]
    terms = spark.createDataFrame([(w,) for w in words], "t string")
    found = search_terms(docs, "id", "text", terms, "t", "t")
    assert not [c for c in stored if "_doc" in c]
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    want = sorted((w, d) for w in words if w for d, t in texts if d and t and w in t)
    assert sorted(map(tuple, found.collect())) == want
    twice = docs.unionByName(spark.createDataFrame([(1, "abc zz")], docs.schema))
    got = sorted(map(tuple, search_terms(twice, "id", "text", terms, "t", "t").collect()))
    assert got == sorted({*want, ("zz", 1)})
