from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from loomwire.functions import text as T
from loomwire.functions.stopwords import ENGLISH, PRODUCT
from loomwire.operators import counts as C
from loomwire.operators.keywords import keyword_frequencies, keyword_pairs, with_matches
from loomwire.operators.lemmas import clean_with_lemmas
from loomwire.operators.search import search_articles

SLOW = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


@pytest.mark.parametrize("text, a, b", [
    ("wool-blend don't", ["woolblend", "dont"], ["wool", "blend", "don't"]),
    ("tacón", ["tacn"], ["tac", "n"]), ("foo bar", ["foo", "bar"], ["foo", "bar"]),
    (None, [], []), ("", [], []), ("  ", [], [])])
def test_tokenisers(spark, text, a, b):
    assert one(spark, text, T.tokens_strip("x")) == a
    assert one(spark, text, T.tokens_regex("x")) == b


def test_words_repeat_after_the_filter(spark):
    assert one(spark, "the dress a dress of it", T.drop_words(T.tokens_regex("x"), PRODUCT)) == ["dress", "dress"]


def test_bigrams(spark):
    assert one(spark, ["a", "b", "c"], T.bigrams("x"), "array<string>") == ["a b", "b c"]
    assert one(spark, ["a"], T.bigrams("x"), "array<string>") == [] == one(spark, [], T.bigrams("x"), "array<string>")


@pytest.mark.parametrize("html, text", [
    ("<p>A<b>B</b>C</p>", "A B C"), ("<p>A</p><p>B</p>", "A B"), ("A<!-- x > y -->B", "A B"),
    ("a<script>if (1 < 2) x('</p>')</script>b<style>p{}</style>", "a b"), ("<script>open", ""),
    ('<a title="x > y" href=\'z\'>t</a>', "t"), ("1 < 2 &amp;lt; 3", "1 < 2 &lt; 3"),
    ("&eacute;&#233;&#xE9;&nosuch;&#0;", "ééé&nosuch;�"), ("&nbsp; x &hellip;", "x …"), (None, None),
    ("<i>" * 20000 + "deep", "deep"), ("&#128512;", "😀")])
def test_html_to_text(spark, html, text):
    assert one(spark, html, T.html_to_text("x")) == text


def test_highlight(spark):
    assert one(spark, "ÉTÉ été a+b aab", T.highlight("x", ["été", "a+b"])) == "[ÉTÉ] [été] [a+b] aab"


def test_list_round_trip(spark):
    assert one(spark, " a,  b ,c", T.split_list("x")) == ["a", "b ,c"]  # the separator is comma and blank
    assert one(spark, None, T.split_list("x")) == []


SEED = [(0, "fit", "Fur"), (1, "fit", "lace"), (2, "mood", "new"), (3, "mood", "fur"), (4, "x", "a.b"), (5, "y", "é")]
TEXTS = [(1, "further place"), (2, "The NEWS"), (3, "nothing"), (4, "a.b CAFÉ"), (5, "axb")]


@pytest.fixture()
def matching(spark):
    return (spark.createDataFrame(TEXTS, "id int, t string"),
            spark.createDataFrame(SEED, "ord int, category string, keyword string"))


def test_keywords_by_substring(matching):
    docs, seed = matching
    got = {r["id"]: (r["matched_keywords"], r["tags"])
           for r in with_matches(docs, F.lower("t"), seed).collect()}
    assert got == {1: (["Fur", "lace", "fur"], ["fit", "mood"]), 2: (["new"], ["mood"]), 3: ([], []),
                   4: (["a.b", "é"], ["x", "y"]), 5: ([], [])}


def test_keywords_whole_word(matching):
    docs, seed = matching
    got = keyword_pairs(docs, "id", F.lower("t"), seed, whole_word=True)
    assert {(r["id"], r["keyword"]) for r in got.collect()} == {(4, "a.b")}


@settings(**SLOW)
@given(st.lists(st.text("abé ", max_size=12), min_size=1, max_size=6),
       st.lists(st.text("abé", min_size=1, max_size=6), min_size=1, max_size=6))
def test_keywords_agree_with_python(spark, texts, words):
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    seed = spark.createDataFrame([(i, "c", w) for i, w in enumerate(words)], "ord int, category string, keyword string")
    expected = Counter((i, o) for i, t in enumerate(texts) for o, w in enumerate(words) if w in t)
    pairs = keyword_pairs(docs, "id", F.lower("t"), seed)
    assert Counter((r["id"], r["ord"]) for r in pairs.collect()) == expected


def test_keywords_null_category_and_shared_keys(spark):
    docs = spark.createDataFrame([(1, "fur"), (1, "lace"), (None, "fur"), (2, None)], "id int, t string")
    seed = spark.createDataFrame([(1, None, "fur"), (None, "c", "lace"), (3, "d", None), (4, "e", "")],
                                 "ord int, category string, keyword string")
    got = [(r["id"], r["matched_keywords"], r["tags"]) for r in with_matches(docs, F.col("t"), seed).collect()]
    assert sorted(got, key=repr) == sorted([(1, ["fur", ""], ["e"]), (1, ["lace", ""], ["c", "e"]), (None, ["fur", ""], ["e"]),
                                            (2, [], [])], key=repr)


def test_keyword_frequencies(spark):
    df = spark.createDataFrame([("a, b",), ("b",), ("",), (None,)], "matched_keywords string")
    assert [tuple(r) for r in keyword_frequencies(df).collect()] == [("b", 2), ("a", 1)]


def corpus_pairs(docs):
    words = [w for _, tokens in sorted(docs) for w in tokens]
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


@settings(**SLOW)
@given(st.lists(st.tuples(st.sampled_from([0, 1, 7, 65_535, 65_536, 65_537, 1 << 20, 1 << 33, (1 << 38) - 1, 1 << 48, (1 << 63) - 1]),
                          st.lists(st.sampled_from("abc"), max_size=4)), min_size=1, max_size=9, unique_by=lambda d: d[0]))
def test_corpus_pairs_cross_documents_and_groups(spark, docs):
    df = spark.createDataFrame(docs, "ord long, tokens array<string>").repartition(3)
    got = C.pair_counts(df, "tokens", "ord", cross_document=True).collect()
    assert Counter({r["term"]: r["count"] for r in got}) == corpus_pairs(docs)
    inside = C.pair_counts(df, "tokens", "ord").collect()
    assert sum(r["count"] for r in inside) == sum(max(0, len(t) - 1) for _, t in docs)


def test_corpus_text_is_read_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", T.tokens_strip("text").alias("tokens"))
    out = C.pair_counts(df, "tokens", "doc_id", cross_document=True)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_top_k_ties_in_order_of_occurrence(spark):
    docs = spark.createDataFrame([(0, ["z", "b", "b"]), (1, ["a", "z"])], "ord long, tokens array<string>")
    got = C.top_k(C.term_counts(docs, "tokens", "ord"), 3).collect()
    assert [(r["term"], r["count"]) for r in got] == [("z", 2), ("b", 2), ("a", 1)]
    with pytest.raises(Exception, match="below 0"):
        C.term_counts(spark.createDataFrame([(-1, ["a"])], "ord long, tokens array<string>"), "tokens", "ord").collect()


def test_ties_by_the_librarys_own_order(spark):
    """monotonically_increasing_id over many partitions exceeds 38 bits."""
    words = [f"w{i % 7}" for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(words)), "n int, w string").repartitionByRange(40, "n").select(
        F.monotonically_increasing_id().alias("ord"), "n", F.array("w", F.lit("z")).alias("tokens"))
    assert docs.agg(F.max("ord")).first()[0] > 1 << 38
    got = [r["term"] for r in C.top_k(C.term_counts(docs, "tokens", "ord"), 8).collect()]
    assert got == ["z", "w0", "w1", "w2", "w3", "w4", "w5", "w6"]
    pairs = {r["term"]: r["count"] for r in C.pair_counts(docs, "tokens", "ord", cross_document=True).collect()}
    stream = [x for w in words for x in (w, "z")]
    assert pairs == Counter(f"{a} {b}" for a, b in zip(stream, stream[1:]))


def test_search(spark):
    df = spark.createDataFrame([("Lace dress", "A LACE dress", "l1"), (None, None, "l2"), ("x", "a+b", "l3")],
                               "title string, summary string, link string")
    got = [tuple(r) for r in search_articles(df, ["lace dress", "A+b", "one two three", ""]).collect()]
    assert got == [("lace dress", "Lace dress", "A [LACE] [dress]", "l1"), ("A+b", "x", "[a+b]", "l3")]


def test_lemmas(spark):
    df = spark.createDataFrame([(1, "Dresses and dresses were going on"), (2, None)], "id int, t string")
    lemmas = spark.createDataFrame([("dresses", "dress"), ("going", "go")], "word string, lemma string")
    got = {r["id"]: r["text_clean"] for r in clean_with_lemmas(df, "id", "t", lemmas, ENGLISH).collect()}
    assert got == {1: "dress dress", 2: ""}
