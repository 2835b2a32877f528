"""Fitted TF-IDF vectors: equal to SQL, and the same after saving and loading the model."""

import uuid

import pytest
from pyspark.ml import PipelineModel

import __spark_entry__ as entry
from compare import connect, difference
from loomwire.functions.text import tokens_unicode
from loomwire.operators.vectors import fit_text_vectors, text_vectors
from loomwire.session import shared_folder


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_tfidf_equals_sql(spark, sf):
    assert difference(entry.queries()["tfidf_vectors"](spark, sf), connect(sf), entry.oracle_sql()["tfidf_vectors"]) is None


def test_save_and_load(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", tokens_unicode("text").alias("tokens"))
    model = fit_text_vectors(docs, "tokens", 0.1)
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    first = {r["doc_id"]: r["embedding"] for r in text_vectors(model, docs, "tokens").collect()}
    second = {r["doc_id"]: r["embedding"] for r in text_vectors(again, docs, "tokens").collect()}
    assert first == second
    assert all(abs(sum(x * x for x in v) - 1) < 1e-5 or not any(v) for v in first.values())
