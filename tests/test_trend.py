import math
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from loomwire.functions.scores import clip
from loomwire.functions.web import dedupe_key, source_host
from loomwire.functions.weeks import parse_ts, year_week
from loomwire.operators.dedupe import drop_known, keep_first, keep_last
from loomwire.plans.trend import trend_scores, with_previous, with_scores
from loomwire.schemas import TREND_SCORES, require_columns

ARTICLE = "title string, link string, ingested_at string, topic int, n int"


def scored(spark, rows, **kw):
    df = spark.createDataFrame(rows, ARTICLE)
    return {r["topic"]: r for r in trend_scores(df, order=("ingested_at", "n"), **kw).collect()}


def test_published_scores(spark):
    """Five topics which hold the extremes of a published table, so that their scores equal its."""
    rows = [("-1", 1, 327, 1, -0.9969418960244648, 329, 7.455783851392363),
            ("0", 829, 186, 14, 3.456989247311828, 1844, 100.0),
            ("1", 10, 103, 2, -0.9029126213592233, 123, 7.082000519673246),
            ("10", 0, 50, 0, -1.0, 50, 0.734094616639478), ("28", 0, 5, 0, -1.0, 5, 0.0)]
    from loomwire.operators.weeks import with_metrics
    counts = spark.createDataFrame([r[:4] for r in rows],
                                   "topic string, mentions_this_week long, mentions_prev_week long, source_count long")
    got = {r["topic"]: r for r in with_scores(with_metrics(counts)).collect()}
    for topic, _, _, _, velocity, recency, score in rows:
        assert got[topic]["velocity"] == velocity and got[topic]["recency"] == recency
        assert math.isclose(got[topic]["trend_score"], score, abs_tol=1e-9)


def test_schema_and_first_run(spark):
    df = spark.createDataFrame([("a", "", "2024-01-01", 1, 1)], ARTICLE)
    out = trend_scores(df, order=("ingested_at", "n"))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in TREND_SCORES]
    row = out.first()
    # one topic: all norms are constant, so 0; one week: nothing before it
    assert (row["trend_score"], row["velocity"], row["score_prev"], row["source_count"]) == (0.0, 1.0, None, 1)


def test_gap_junk_time_and_old_topics(spark):
    got = scored(spark, [("a", "http://x/1", "2024-03-04T10:00:00+00:00", 1, 1),
                         ("b", "http://x/2", "junk", 1, 2),
                         ("c", "http://x/3", "2024-01-03", 1, 3), ("d", "http://x/4", "2024-01-04", 1, 4),
                         ("e", "http://y/5", "2023-01-04", 2, 5)])
    assert (got["1"]["mentions_this_week"], got["1"]["mentions_prev_week"]) == (1, 2)
    assert (got["2"]["mentions_this_week"], got["2"]["mentions_prev_week"], got["2"]["velocity"]) == (0, 0, 0.0)
    calendar = scored(spark, [("a", "http://x/1", "2024-03-04", 1, 1), ("c", "http://x/3", "2024-01-03", 1, 3)],
                      calendar_prev=True)
    assert calendar["1"]["mentions_prev_week"] == 0


@pytest.mark.parametrize("day, before", [("2024-03-04", "2024-02-26"), ("2024-01-08", "2024-01-02"),
                                         ("2025-01-01", "2024-12-31"), ("2025-01-06", "2025-01-03")])
def test_calendar_previous_week(spark, day, before):
    got = scored(spark, [("a", "u/1", day, 1, 1), ("b", "u/2", before, 1, 2)], calendar_prev=True)
    assert got["1"]["mentions_prev_week"] == 1


def test_last_copy_counts_and_headlines(spark):
    week = "2024-01-0"
    rows = [("same", "l", "2024-01-01", 1, 1), ("same", "l", "2024-01-09", 1, 2)]
    rows += [("t", f"x{i}", "2024-01-08", 1, 10 + i) for i in range(4)]
    rows += [(t, f"y{t}", "2024-01-10", 1, 20 + i) for i, t in enumerate("uvw")] + [(None, "z", "2024-01-08", 1, 9)]
    got = scored(spark, rows)["1"]
    assert got["rep_headlines"] == "t || same || u"
    assert (got["mentions_this_week"], got["mentions_prev_week"]) == (9, 0)


def test_clip_only_for_norms(spark):
    rows = [("a", f"http://h/{i}", "2024-01-08", 1, i) for i in range(100)] + [("b", "http://h/x", "2024-01-08", 2, 200)]
    rows += [("b", f"http://h/y{i}", "2024-01-02", 2, 300 + i) for i in range(2)]
    got = scored(spark, rows)
    assert got["1"]["velocity"] == 100 and got["1"]["velocity_norm"] == 1.0
    assert [r[0] for r in spark.range(1).select(F.explode(F.array(F.lit(9.0), F.lit(-9.0), F.lit(1.5))).alias("v"))
            .select(clip("v")).collect()] == [5.0, -5.0, 1.5]


def test_previous_snapshot_by_text(spark):
    now = spark.createDataFrame([("1", 10.0), ("2", 5.0)], "topic string, trend_score double")
    old = spark.createDataFrame([(1, 4.0)], "topic int, trend_score double")
    assert {tuple(r) for r in with_previous(now, old).select("topic", "score_prev", "score_delta").collect()} == {
        ("1", 4.0, 6.0), ("2", None, None)}


def test_week_keys_equal_strftime(spark):
    start = date(2020, 1, 1)
    days = [start + timedelta(days=i) for i in range(4383)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", year_week("d"), year_week("d", iso=True)).collect()
    assert all(r[1] == r[0].strftime("%Y-%W") and r[2] == r[0].strftime("%G-%V") for r in got)


@pytest.mark.parametrize("link, source", [("https://user@www.Shop.com:80/x", "user@shop.com:80"), ("", ""), (None, ""),
                                          ("//www.a.www.b/c", "a.b"), ("no address", "")])
def test_source(spark, link, source):
    assert spark.createDataFrame([(link,)], "link string").select(source_host("link")).first()[0] == source


def test_parse_ts(spark):
    rows = spark.createDataFrame([("2025-09-25T19:16:29.5+00:00",), ("2025-09-25T19:16:29+02:00",), ("x",), (None,)], "t string")
    got = [r[0] for r in rows.select(F.date_format(parse_ts("t"), "dd HH:mm:ss")).collect()]
    assert got == ["25 19:16:29", "25 17:16:29", None, None]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="ingested_at"):
        require_columns(spark.range(1), ["ingested_at"])


def test_dedupe(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, None), (None, 3, "c"), (None, 4, "d")], "k string, n int, v string")
    assert {tuple(r) for r in keep_first(df, ["k"], ["n"]).collect()} == {("k", 1, "a"), (None, 3, "c")}
    assert {tuple(r) for r in keep_last(df, ["k"], ["n"]).collect()} == {("k", 2, None), (None, 4, "d")}
    assert {r["n"] for r in drop_known(df, df.where("k = 'k'"), ["k"]).collect()} == {3, 4}
    key = spark.createDataFrame([("", "t", "s")], "link string, title string, summary string").select(dedupe_key()).first()[0]
    import hashlib
    assert key == hashlib.sha1(b"ts").hexdigest()


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr("if(id % 3 = 0, 'hot', string(id)) AS k", "id AS n")
    kept = keep_last(df, ["k"], ["n"])
    assert kept.where("k = 'hot'").first()["n"] == 99_999
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning(k")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["l1", "l2", ""]), st.integers(1, 28), st.integers(0, 2)),
                min_size=1, max_size=25))
def test_properties(spark, raw):
    rows = [(t, link, f"2024-01-{day:02d}", topic, i) for i, (t, link, day, topic) in enumerate(raw)]
    got = scored(spark, rows)
    distinct = {(t, link, topic): day for t, link, day, topic in raw}
    assert set(got) == {str(topic) for _, _, topic in distinct}
    last = max(date(2024, 1, d).strftime("%Y-%W") for d in _kept_days(raw))
    this = sum(1 for d in _kept_days(raw) if date(2024, 1, d).strftime("%Y-%W") == last)
    assert sum(r["mentions_this_week"] for r in got.values()) == this
    assert all(0 <= r[n] <= 1 for r in got.values() for n in ("velocity_norm", "recency_norm", "source_norm"))
    assert all(-1e-9 <= r["trend_score"] <= 100 + 1e-9 for r in got.values())


def _kept_days(raw):
    kept = {}
    for i, (t, link, day, topic) in enumerate(raw):
        kept[t, link, topic] = max(kept.get((t, link, topic), (0, 0)), (day, i))
    return [day for day, _ in kept.values()]
