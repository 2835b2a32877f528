"""Approximate source diversity from mergeable HLL sketches against the exact form."""

import math

from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomwire.operators import weeks as W


def test_approx_within_bound_of_exact(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        exact = {r["topic"]: r["source_count"] for r in entry.queries()["source_diversity"](spark, sf).collect()}
        approx = {r["topic"]: r["source_count"] for r in entry.queries()["source_diversity_approx"](spark, sf).collect()}
        assert set(approx) == set(exact)
        for topic, n in exact.items():
            assert abs(approx[topic] - n) <= 3 * 1.04 / math.sqrt(1 << 12) * n + 1


def test_sketches_merge_like_one_reading(spark):
    rows = [(t, "2024-01", f"s{i % (7 + 3 * t)}") for t in range(4) for i in range(400)] + [(9, "2023-52", "a"),
                                                                                       (9, "2023-52", None)]
    df = spark.createDataFrame(rows, "topic int, year_week string, source string")
    whole = {r["topic"]: r["source_count"] for r in W.approx_source_diversity(W.source_sketches(df)).collect()}
    halves = W.merge_source_sketches(W.source_sketches(df.where(F.col("source") < "s5")),
                                     W.source_sketches(df.where(~(F.col("source") < "s5") | F.col("source").isNull())))
    merged = {r["topic"]: r["source_count"] for r in W.approx_source_diversity(halves).collect()}
    assert whole == merged == {0: 7, 1: 10, 2: 13, 3: 16, 9: 0}
