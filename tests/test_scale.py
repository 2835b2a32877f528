"""Steps whose time or memory must not grow faster than their input, on small rows of their own."""

import time
from datetime import datetime, timezone

from pyspark.sql import functions as F

from loomwire.functions import text as T
from loomwire.llm.disclosure import _term_documents
from loomwire.operators import counts as C
from loomwire.operators import keywords as K
from loomwire.operators import topic_terms as TT
from loomwire.operators.lemmas import clean_with_lemmas
from loomwire.operators.qgram_search import search_terms
from loomwire.operators.vectors import fit_text_vectors, text_vectors, vector_terms
from loomwire.plans.topics import _nearest_core
from loomwire.sinks import snapshots as O
from loomwire.sources import files as I


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_worker_returns_numbers_of_keywords(spark):
    seed = spark.createDataFrame([(1, "c", "Ab"), (2, None, "ab"), (3, "d", "zz"), (None, "e", "b"), (5, "f", None)],
                                 "ord int, category string, keyword string")
    docs = spark.createDataFrame([(1, "xabx"), (2, None), (3, "")], "id long, text string")
    found = K.with_seeds(docs, F.lower("text"), seed)
    assert "ArrowEvalPython [numbers(" in plan(found, "sparkPlan")  # not rows of the list, which repeats keywords
    rows = {r["id"]: [tuple(s) for s in r["_seeds"]] for r in found.collect()}
    assert rows == {1: [(None, "e", "b"), (1, "c", "Ab"), (2, None, "ab")], 2: [], 3: []}


def test_workers_list_the_rows_of_a_long_list(spark, monkeypatch):
    words = ("Ab", "ab", "b", "", "É é")
    rows = [(None if n % 7 == 0 else n // 2, (None, "c", "B", "é")[n % 4], words[n % 5] if n % 11 else f"x{n}")
            for n in range(1_500)]
    seed = spark.createDataFrame([*rows, (1, "none", None)], "ord int, category string, keyword string")
    docs = spark.createDataFrame([(n, ("xabx", None, "", "É é x33", "b x44 x1")[n % 5], "t") for n in range(3_000)],
                                 "id long, text string, tags string")
    long = K.with_matches(docs, F.lower("text"), seed)
    assert "transform(" not in plan(long)  # an expression takes a microsecond for each row found
    monkeypatch.setattr(K, "_PLACES", 2_000)
    some = K.with_matches(docs, F.lower("text"), seed, whole_word=True)
    monkeypatch.setattr(K, "_SHORT", 2_000)
    for df, words in (long, False), (some, True):
        short = K.with_matches(docs.limit(10), F.lower("text"), seed, whole_word=words)
        assert df.columns == short.columns and "transform(" in plan(short)
        assert df.dtypes == short.dtypes and df.count() == 3_000
        of = {r["text"]: r[1:] for r in df.collect()}
        assert of == {r["text"]: r[1:] for r in short.collect()}


def test_search_of_a_long_text(spark):
    docs = spark.createDataFrame([(1, "abcdefghij é" * 40_000)], "id long, text string")
    terms = spark.createDataFrame([("j éabc",), ("é",), ("zz",), ("ja",)], "t string")
    began = time.time()
    assert {r["t"] for r in search_terms(docs, "id", "text", terms, "t", "t").collect()} == {"j éabc", "é"}
    assert time.time() - began < 20


def test_lemmas_of_a_repeated_key(spark):
    docs = spark.createDataFrame([(1, "cats and dogs"), (1, "the cats run"), (2, None)], "id long, text string")
    words = spark.createDataFrame([("cats", "cat"), ("dogs", "do"), ("run", None)], "word string, lemma string")
    rows = clean_with_lemmas(docs, "id", "text", words, ["the", "and"]).collect()
    assert sorted(map(tuple, rows)) == [(1, "cat"), (1, "cat run"), (2, "")]


def test_nearest_core_without_sort(spark):
    unseen = spark.createDataFrame([([0, 0, 0],), ([90, 0, 0],)], "_point array<long>")
    known = spark.createDataFrame([([1, 0, 0], 5, True), ([-1, 0, 0], 3, True), ([2, 0, 0], 0, True)],
                                  "_point array<long>, topic int, _core boolean")
    found = _nearest_core(unseen, known, 3, 4)
    assert "SortAggregate" not in plan(found, "sparkPlan")
    assert {tuple(r["_point"]): r["topic"] for r in found.collect()} == {(0, 0, 0): 3, (90, 0, 0): -1}


def test_export_in_parts(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = spark.range(6).selectExpr("id AS n", "concat('a\nb', id) AS title").repartitionByRange(3, "n")
    O.export_csv(rows, f"{folder}/h_1.csv")
    O.export_csv(spark.createDataFrame([("x", 9)], "title string, n long"), f"{folder}/h_2.csv")
    assert len(list((tmp_path / "in" / "h_1.csv").glob("part-*"))) == 3
    found = I.all_history(spark, folder, "h", "n long, title string").collect()
    assert [(r["n"], r["title"]) for r in sorted(found, key=lambda r: (r["source_file"], r["row_ord"]))] == [
        *[(i, f"a\nb{i}") for i in range(6)], (9, "x")]
    assert {r["source_file"] for r in found} == {"h_1.csv", "h_2.csv"}
    assert I.newest(spark, folder, "h").endswith("/h_2.csv") and I.left_out(spark, folder, "h").count() == 0
    none = spark.createDataFrame([], "path string")
    fresh = O.archive_new(spark, folder, none, str(tmp_path / "out"), datetime(2024, 1, 2, tzinfo=timezone.utc), "h")
    assert sorted(r["name"] for r in fresh.collect()) == ["h_1.csv", "h_2.csv"]
    stored = spark.read.parquet(str(tmp_path / "out")).groupBy("source_file").count()
    assert {tuple(r) for r in stored.collect()} == {("h_1.csv", 6), ("h_2.csv", 1)}


def test_texts_are_tokenised_once(spark):
    docs = spark.createDataFrame([(0, "one two"), (1, ""), (2, "two")], "id long, text string").select(
        "id", F.lit("t").alias("topic"), T.tokens_strip("text").alias("tokens"))
    pairs = C.pair_counts(docs, "tokens", "id")
    assert plan(pairs).count("split(lower(") == 1
    assert plan(C.term_counts(docs, "tokens")).count("split(lower(") == 1
    both = [{r["term"]: r["count"] for r in df.collect()} for df in C.word_and_pair_counts(docs, "tokens", "id", True)]
    assert both == [{"one": 1, "two": 2}, {"one two": 1, "two two": 1}]


def test_topic_counts_are_shared(spark):
    docs = spark.createDataFrame([("a", "one two"), ("b", "two")], "topic string, text string").select(
        "topic", T.tokens_strip("text").alias("tokens"))
    assert "size(" not in plan(TT.topic_terms(docs, "topic", "tokens"))  # else texts are tokenised for it
    nulls = spark.createDataFrame([("a", ["one", None, "two"])], "topic string, tokens array<string>")
    text = plan(TT.topic_terms(nulls, "topic", "tokens"))
    assert text.count("isnotnull(term") >= text.count("Generate explode")  # all branches filter alike


def test_vector_terms_without_join(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "c", "c"]), (3, ["b"])], "id long, t array<string>")
    model = fit_text_vectors(docs, "t", 2)
    assert model.stages[0].vocabulary == ["a", "b"]
    found = vector_terms(model, text_vectors(model, docs, "t"), "id")
    assert "Join" not in plan(found)
    assert {(r["id"], r["term"]) for r in found.collect()} == {(1, "a"), (1, "b"), (2, "a"), (3, "b")}


def test_words_are_counted_in_slices(spark):
    long = "same words " * 500_000
    docs = spark.createDataFrame([(long,), (long,)], "text string").coalesce(1)
    assert sorted(map(tuple, _term_documents(docs).collect())) == [("same", 1)] * 2 + [("words", 1)] * 2
