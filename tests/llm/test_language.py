"""Nearest-centroid language identification: held-out accuracy, awkward rows, and inputs that must not matter."""

import zlib

from pyspark.sql import functions as F

from cases import awkward, frame
from loomwire.llm import language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    result = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    rows = result.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.95


def test_ids_labels_and_sources_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()}
    # held-out rows with other labels and sources, training rows unchanged
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                             F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    second = {r["doc_id"]: r["lang_pred"] for r in language.identify(changed).collect()}
    assert first == second


def test_awkward_rows(spark):
    rows = awkward() + [(30, "12345 !!! ---"), (31, "der die das und ist nicht mit"), (32, "the and of is with that")]
    df = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") == 31, "de").otherwise(F.col("lang")))
    out = language.identify(df).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    for key in (3, 4, 5, 30):
        assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in by[key])
    assert [r["held_out"] for r in by[None]] == [None, None]
    assert by[8][0]["lang_pred"] == by[8][1]["lang_pred"] and by[8][0]["score"] == by[8][1]["score"]
    assert {r["lang_pred"] for r in out} <= {"und", "en", "de"}


def test_empty_and_unlabelled(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.identify(empty).collect() == []
    bare = spark.createDataFrame([(1, "some words here", None), (2, "more words", None)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.identify(bare).collect()} == {"und"}


def test_grams_are_letters_only():
    b1, c1 = language.grams("Hello, World! 42", 1 << 13)
    b2, c2 = language.grams("hello world", 1 << 13)
    assert (b1 == b2).all() and (c1 == c2).all()
    assert len(language.grams("1234 ...", 64)[0]) == 0
