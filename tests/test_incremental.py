"""Daily steps of the weekly state equal one full run."""

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import connect, difference
from loomwire.checks import views as V
from loomwire.functions.weeks import parse_ts
from loomwire.operators.weeks import weekly_mentions
from loomwire.plans import incremental as I
from loomwire.plans.trend import scored_articles
from loomwire.session import shared_folder

ORDER = ("ingested_at", "doc_id")


def rows(df):
    return sorted(tuple(r) for r in df.select("topic", "year_week", "source", "mentions_by_source").collect())


def test_daily_steps_equal_one_run(spark):
    articles = V.articles(spark, "/root/testdata/sf0.001", time=True, topic=True)
    stamped = articles.withColumn("_day", F.to_date(parse_ts("ingested_at")))
    days = sorted(r[0] for r in stamped.select("_day").distinct().collect() if r[0] is not None)
    state = f"{shared_folder(spark)}/test-state-{uuid.uuid4().hex}"
    # batches of several days, the last out of order, and one batch again: copies replace or are older
    groups = [days[i:i + max(1, len(days) // 6)] for i in range(0, len(days), max(1, len(days) // 6))]
    for group in [*groups[:-2], groups[-1], groups[-2], groups[0]]:
        I.step(spark, state, stamped.where(F.col("_day").isin(group)).drop("_day"), ORDER)
    I.step(spark, state, stamped.where(F.lit(False)).drop("_day"), ORDER)
    assert rows(I.weekly(spark, state)) == rows(weekly_mentions(scored_articles(articles, ORDER)))


def test_a_newer_copy_moves_its_mention(spark):
    state = f"{shared_folder(spark)}/test-state-{uuid.uuid4().hex}"
    schema = "link string, title string, topic string, ingested_at string, doc_id long"
    first = spark.createDataFrame([("https://a.example/x", "T", "1", "2024-01-02 10:00:00", 1)], schema)
    later = spark.createDataFrame([("https://a.example/x", "T", "1", "2024-01-20 10:00:00", 2)], schema)
    I.step(spark, state, first, ORDER)
    I.step(spark, state, later, ORDER)
    I.step(spark, state, first, ORDER)  # an older copy again changes nothing
    got = rows(I.weekly(spark, state))
    assert got == rows(weekly_mentions(scored_articles(first.unionByName(later), ORDER)))
    assert len(got) == 1


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_registered_query_equals_sql(spark, sf):
    query = entry.queries()["incremental_weekly"](spark, sf)
    assert difference(query, connect(sf), entry.oracle_sql()["incremental_weekly"]) is None
