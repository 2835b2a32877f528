"""Trend queries on the test tables with their SQL."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scores import clip
from ..functions.web import dedupe_key, source_host
from ..functions.weeks import parse_ts, year_week
from ..operators.dedupe import drop_known, keep_first, keep_last
from ..operators.topic_terms import topic_sizes
from ..operators import weeks as W
from ..plans import incremental as I
from ..plans import trend as P
from ..schemas import CLEAN_COLUMNS, keep_columns
from ..session import shared_folder
from ..sinks.snapshots import archive_day, archive_new, export_csv, write_snapshot
from ..sources import files
from ..sources.snapshots import new_since, read_latest, union_snapshots
from . import views as V
from .views import SQL_ARTICLES, SQL_HEADLINES, SQL_KEPT, sql_metrics, sql_scores, table

ORDER = ("ingested_at", "doc_id")
STAMP, SQL_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS", "%Y-%m-%d %H:%M:%S.%f"


def _kept(spark: SparkSession, d: str) -> DataFrame:
    return P.scored_articles(V.articles(spark, d, time=True, topic=True), ORDER)


def _weekly(spark: SparkSession, d: str) -> DataFrame:
    return W.weekly_mentions(_kept(spark, d))


def incremental_weekly(spark: SparkSession, d: str) -> DataFrame:
    """The weekly mentions from two steps of the stored state: all but the last seven days, then those days."""
    articles = V.articles(spark, d, time=True, topic=True)
    ts = parse_ts("ingested_at") if dict(articles.dtypes)["ingested_at"] == "string" else F.col("ingested_at")
    stamped = articles.withColumn("_ts", ts)
    last = stamped.agg(F.max("_ts")).first()[0]
    state = f"{shared_folder(spark)}/weekly-state-{uuid.uuid4().hex}"
    if last is not None:
        recent = F.col("_ts") >= F.lit(last) - F.expr("INTERVAL 7 DAYS")
        I.step(spark, state, stamped.where(~recent | F.col("_ts").isNull()).drop("_ts"), ORDER)
        I.step(spark, state, stamped.where(recent).drop("_ts"), ORDER)
    else:
        I.step(spark, state, articles, ORDER)
    if last is None:
        return _weekly(spark, d).limit(0)
    return I.weekly(spark, state)


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return W.with_metrics(W.this_and_previous(_weekly(spark, d)))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def _previous(weekly: DataFrame) -> DataFrame:
    """Scores as they were a week before."""
    older = W.with_observed_weeks(weekly, weekly).where("year_week < latest").select(weekly.columns)
    return P.with_scores(W.with_metrics(W.this_and_previous(older)))


def trend_scores(spark: SparkSession, d: str) -> DataFrame:
    scores = P.trend_scores(V.articles(spark, d, time=True, topic=True), order=ORDER)
    return _rounded(scores, "velocity", "velocity_norm", "recency_norm", "source_norm", "trend_score").drop(
        "score_prev", "score_delta")


def prev_snapshot_join(spark: SparkSession, d: str) -> DataFrame:
    weekly = _weekly(spark, d)
    scores = P.with_scores(W.with_metrics(W.this_and_previous(weekly)))
    out = P.with_previous(scores, _previous(weekly)).select("topic", "trend_score", "score_prev", "score_delta")
    return _rounded(out, "trend_score", "score_prev", "score_delta")


def score_delta(spark: SparkSession, d: str) -> DataFrame:
    return prev_snapshot_join(spark, d).select("topic", "score_delta")


def trend_score(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(P.with_scores(_metrics(spark, d)).select("topic", "trend_score"), "trend_score")


def minmax_normalize(spark: SparkSession, d: str) -> DataFrame:
    norms = ("velocity_norm", "recency_norm", "source_norm")
    return _rounded(P.normalised(_metrics(spark, d)).select("topic", *norms), *norms)


def clipped(spark: SparkSession, d: str) -> DataFrame:
    # a bound which the data reaches
    return _rounded(_metrics(spark, d).select("topic", clip("velocity", 0.7).alias("clipped")), "clipped")


def rep_headlines(spark: SparkSession, d: str) -> DataFrame:
    kept = _kept(spark, d)
    return P.representative_headlines(kept, W.weekly_mentions(kept), ORDER)


def dedupe_first(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(
        "doc_id", "lang", dedupe_key(F.lit(""), F.lit(""), "text").alias("key"))
    return keep_first(docs, ["key"], ["doc_id"])


def dedupe_last(spark: SparkSession, d: str) -> DataFrame:
    rows = V.articles(spark, d, time=True, topic=True).select("link", "title", "topic", "doc_id", "ingested_at")
    return keep_last(rows, P.DEDUPE_KEYS, ORDER).select("doc_id", "title", "topic")


def known_keys(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.sha1("text").alias("key"))
    seen = table(spark, d, "benchmark").select(F.sha1("text").alias("key")).unionByName(
        docs.join(table(spark, d, "labels"), "doc_id", "left_semi").select("key"))
    return drop_known(docs, seen, ["key"]).select("doc_id", "key")


def parsed(spark: SparkSession, d: str) -> DataFrame:
    ts, n = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.col("event_id")
    text = (F.when(n % 5 == 0, F.lit("junk")).when(n % 5 == 1, F.concat(ts, F.lit("+02:00")))
            .when(n % 5 == 2, F.concat(ts, F.lit("Z"))).otherwise(F.concat(ts, F.lit("+00:00"))))
    return table(spark, d, "events").select("event_id", F.date_format(parse_ts(text), STAMP).alias("parsed"))


def week_keys(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_add(F.to_date("ts"), (F.col("event_id") % 4383).cast("int"))
    return (table(spark, d, "events").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
            .select("day", "n", year_week("day").alias("year_week"))
            .select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n", "year_week"))


def hosts(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("link"))
    links = V.articles(spark, d).select(F.col("doc_id").alias("id"), "link")
    return pages.unionByName(links).select("id", "link", source_host("link").alias("source"))


def kept_columns(spark: SparkSession, d: str) -> DataFrame:
    return keep_columns(V.articles(spark, d), CLEAN_COLUMNS)


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _landed(spark: SparkSession, rows: DataFrame, folder: str, name: str) -> None:
    """Rows as a CSV export with the given columns and name, a folder with a part per task."""
    export_csv(rows, f"{folder}/{name}")


def _exports(spark: SparkSession, d: str) -> str:
    """Three exports with columns in different orders, of which each lacks one."""
    folder = _folder(spark)
    _landed(spark, table(spark, d, "documents").select("doc_id", "text", "lang"), folder, "h_20240101_000000.csv")
    _landed(spark, table(spark, d, "benchmark").select("text", "item_id"), folder, "h_20240102_000000.csv")
    _landed(spark, table(spark, d, "labels").select("toxic", "quality", "doc_id"), folder, "h_20240103_000000.csv")
    return folder


HISTORY = "doc_id long, item_id long, text string, lang string, quality int"


def all_history(spark: SparkSession, d: str) -> DataFrame:
    """Exports with different columns as one table by name, with the file each row came from."""
    rows = files.all_history(spark, _exports(spark, d), "h", HISTORY)
    return rows.select("doc_id", "item_id", F.md5("text").alias("text_md5"), "lang", "quality", "source_file")


def newest_export(spark: SparkSession, d: str) -> DataFrame:
    """The newest export's rows."""
    folder = _exports(spark, d)
    newest = files.newest(spark, folder, "h")
    return files.read_csv(spark, newest, "doc_id long, quality int, text string")


def archived(spark: SparkSession, d: str) -> DataFrame:
    """What two runs of the archive over the same new files hold: each file once."""
    folder, archive = _exports(spark, d), _folder(spark)
    before = files.list_exports(spark, folder, "h_20240101*.csv")
    for _ in range(2):
        archive_new(spark, folder, before, archive, datetime(2024, 1, 3), "h")
    return spark.read.parquet(archive).groupBy("run_day", "source_file").agg(F.count(F.lit(1)).alias("n"))


def unioned(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.length("text").alias("n"), "lang")
    bench = table(spark, d, "benchmark").select("item_id", F.length("text").alias("n"))
    talks = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    return union_snapshots(docs, bench, talks)


def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The newest run of a versioned table; only its partition is read."""
    root = _folder(spark)
    events = table(spark, d, "events").withColumn("day", F.dayofmonth("ts"))
    for run in (1, 2):
        write_snapshot(events.where(F.col("day") % 2 == run % 2).select("event_id", "event_type"), root, f"2024010{run}_000000")
    return read_latest(spark, root)


def fresh(spark: SparkSession, d: str) -> DataFrame:
    listing = table(spark, d, "documents").select("doc_id", "source")
    return new_since(listing, table(spark, d, "labels"), ["doc_id"])


def dated_archive(spark: SparkSession, d: str) -> DataFrame:
    rows = V.articles(spark, d, time=True).select("doc_id", "ingested_at")
    days = new_since(rows, table(spark, d, "labels"), ["doc_id"])
    return days.groupBy(archive_day(F.col("ingested_at")).alias("run_day")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "trend_scores": trend_scores,
    "velocity": lambda s, d: _rounded(_metrics(s, d).select("topic", "velocity"), "velocity"),
    "recency": lambda s, d: _metrics(s, d).select("topic", "recency"),
    "clip": clipped,
    "trend_score": trend_score,
    "score_delta": score_delta,
    "prev_snapshot_join": prev_snapshot_join,
    "minmax_normalize": minmax_normalize,
    "rep_headlines": rep_headlines,
    "top_topics": lambda s, d: _rounded(P.top_topics(P.with_scores(_metrics(s, d))), "trend_score"),
    "this_prev_week": lambda s, d: W.this_and_previous(_weekly(s, d)),
    "source_diversity": lambda s, d: W.this_and_previous(_weekly(s, d)).select("topic", "source_count"),
    "source_diversity_approx": lambda s, d: W.approx_source_diversity(W.source_sketches(_kept(s, d))),
    "topic_week_mentions": lambda s, d: W.topic_weeks(_weekly(s, d)),
    "topic_week_source_mentions": _weekly,
    "incremental_weekly": incremental_weekly,
    "week_histogram": lambda s, d: W.week_histogram(_weekly(s, d)),
    "recent_weeks": lambda s, d: W.recent_weeks(_weekly(s, d), 3).select("year_week"),
    "latest_week_semi": lambda s, d: W.of_latest_week(_kept(s, d), _weekly(s, d)).select("doc_id", "topic", "source"),
    "topic_sizes": lambda s, d: topic_sizes(V.articles(s, d, topic=True)),
    "dedupe_first": dedupe_first,
    "dedupe_last": dedupe_last,
    "dedupe_known": known_keys,
    "dedupe_key": lambda s, d: V.articles(s, d).select("doc_id", dedupe_key().alias("key")),
    "parse_ts": parsed,
    "drop_bad_ts": lambda s, d: parsed(s, d).dropna(subset=["parsed"]).select("event_id"),
    "year_week": week_keys,
    "source_host": hosts,
    "keep_columns": kept_columns,
    "all_history": all_history,
    "newest_export": newest_export,
    "archive_new": archived,
    "topics_as_text": lambda s, d: P.topics_as_text(V.articles(s, d, topic=True)),
    "union_snapshots": unioned,
    "latest_snapshot": latest_snapshot,
    "new_since": fresh,
    "dated_archive": dated_archive,
}

_M = f"WITH {SQL_KEPT}, {sql_metrics()}"
_S = f"{_M}, {sql_scores()}"
_PREV = f"""{_S}, {sql_metrics(2)}, {sql_scores(2)}"""
_PARSED = f"""SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL
  WHEN 1 THEN strftime(ts - INTERVAL 2 HOUR, '{SQL_STAMP}') ELSE strftime(ts, '{SQL_STAMP}') END AS parsed FROM events"""

ORACLES = {
    "trend_scores": f"""{_S}, {SQL_HEADLINES}
SELECT topic, this AS mentions_this_week, prev AS mentions_prev_week, round(velocity, 6) AS velocity, recency,
  sources AS source_count, coalesce(rep_headlines, '') AS rep_headlines, round(velocity_norm, 6) AS velocity_norm,
  round(recency_norm, 6) AS recency_norm, round(source_norm, 6) AS source_norm, round(trend_score, 6) AS trend_score
FROM scores LEFT JOIN headlines USING (topic)""",
    "velocity": f"{_M} SELECT topic, round(velocity, 6) AS velocity FROM metrics",
    "recency": f"{_M} SELECT topic, recency FROM metrics",
    "clip": f"{_M} SELECT topic, round(greatest(-0.7::DOUBLE, least(0.7::DOUBLE, velocity)), 6) AS clipped FROM metrics",
    "trend_score": f"{_S} SELECT topic, round(trend_score, 6) AS trend_score FROM scores",
    "score_delta": f"""{_PREV} SELECT topic, round(s.trend_score - p.trend_score, 6) AS score_delta
FROM scores s LEFT JOIN scores2 p USING (topic)""",
    "prev_snapshot_join": f"""{_PREV} SELECT topic, round(s.trend_score, 6) AS trend_score,
  round(p.trend_score, 6) AS score_prev, round(s.trend_score - p.trend_score, 6) AS score_delta
FROM scores s LEFT JOIN scores2 p USING (topic)""",
    "minmax_normalize": f"""{_S} SELECT topic, round(velocity_norm, 6) AS velocity_norm,
  round(recency_norm, 6) AS recency_norm, round(source_norm, 6) AS source_norm FROM scores""",
    "rep_headlines": f"WITH {SQL_KEPT}, {SQL_HEADLINES} SELECT * FROM headlines",
    "top_topics": f"""{_S} SELECT topic, round(trend_score, 6) AS trend_score, this AS mentions_this_week,
  sources AS source_count FROM scores ORDER BY scores.trend_score DESC, topic LIMIT 10""",
    "this_prev_week": f"""{_M} SELECT topic, this AS mentions_this_week, prev AS mentions_prev_week,
  sources AS source_count FROM metrics""",
    "source_diversity": f"{_M} SELECT topic, sources AS source_count FROM metrics",
    "topic_week_mentions": f"WITH {SQL_KEPT} SELECT topic, year_week, count(*) AS mentions FROM kept GROUP BY ALL",
    "topic_week_source_mentions": f"WITH {SQL_KEPT} SELECT topic, year_week, source, n AS mentions_by_source FROM weekly",
    "incremental_weekly": f"WITH {SQL_KEPT} SELECT topic, year_week, source, n AS mentions_by_source FROM weekly",
    "week_histogram": f"WITH {SQL_KEPT} SELECT year_week, count(*) AS articles FROM kept GROUP BY ALL",
    "recent_weeks": f"WITH {SQL_KEPT} SELECT year_week FROM weeks WHERE k <= 3",
    "latest_week_semi": f"""WITH {SQL_KEPT} SELECT doc_id, topic, source FROM kept
WHERE year_week IN (SELECT year_week FROM weeks WHERE k = 1)""",
    "topic_sizes": f"WITH {SQL_ARTICLES} SELECT topic, count(*) AS count FROM articles GROUP BY topic",
    "dedupe_first": """SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, sha1(text) AS key
FROM documents GROUP BY text""",
    "dedupe_last": f"""WITH {SQL_ARTICLES} SELECT doc_id, title, topic FROM articles
QUALIFY row_number() OVER (PARTITION BY link, title, topic ORDER BY ingested_at DESC, doc_id DESC) = 1""",
    "dedupe_known": """SELECT doc_id, sha1(text) AS key FROM documents WHERE text NOT IN (
  SELECT text FROM benchmark UNION ALL SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))""",
    "dedupe_key": f"""WITH {SQL_ARTICLES} SELECT doc_id,
  CASE WHEN link <> '' THEN link ELSE sha1(title || summary) END AS key FROM articles""",
    "parse_ts": _PARSED,
    "drop_bad_ts": f"SELECT event_id FROM ({_PARSED}) WHERE parsed IS NOT NULL",
    "year_week": """SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n, strftime(day, '%Y-%W') AS year_week
FROM (SELECT CAST(ts AS DATE) + CAST(event_id % 4383 AS INTEGER) AS day FROM events) GROUP BY day""",
    "source_host": f"""WITH {SQL_ARTICLES} SELECT id, link,
  replace(lower(regexp_extract(link, '://([^/?#]*)', 1)), 'www.', '') AS source
FROM (SELECT page_id AS id, url AS link FROM pages UNION ALL SELECT doc_id, link FROM articles)""",
    "keep_columns": f"WITH {SQL_ARTICLES} SELECT title, summary, link FROM articles",
    "all_history": """SELECT doc_id, NULL::BIGINT AS item_id, md5(text) AS text_md5, lang, NULL::INTEGER AS quality,
  'h_20240101_000000.csv' AS source_file FROM documents
UNION ALL SELECT NULL, item_id, md5(text), NULL, NULL, 'h_20240102_000000.csv' FROM benchmark
UNION ALL SELECT doc_id, NULL, NULL, NULL, quality, 'h_20240103_000000.csv' FROM labels""",
    "newest_export": "SELECT doc_id, quality, NULL::VARCHAR AS text FROM labels",
    "archive_new": """SELECT '03-01-2024' AS run_day, 'h_20240102_000000.csv' AS source_file, count(*) AS n FROM benchmark
UNION ALL SELECT '03-01-2024', 'h_20240103_000000.csv', count(*) FROM labels""",
    "topics_as_text": f"WITH {SQL_ARTICLES} SELECT DISTINCT CAST(topic AS VARCHAR) AS topic FROM articles WHERE topic IS NOT NULL",
    "union_snapshots": """SELECT doc_id, CAST(length(text) AS INTEGER) AS n, lang, NULL::BIGINT AS item_id,
  NULL::BIGINT AS conv_id, NULL::BIGINT AS turn FROM documents
UNION ALL SELECT NULL, CAST(length(text) AS INTEGER), NULL, item_id, NULL, NULL FROM benchmark
UNION ALL SELECT NULL, CAST(length(text) AS INTEGER), NULL, NULL, conv_id, turn FROM conversations""",
    "latest_snapshot": "SELECT event_id, event_type FROM events WHERE day(ts) % 2 = 0",
    "new_since": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "dated_archive": f"""WITH {SQL_ARTICLES} SELECT strftime(ingested_at, '%d-%m-%Y') AS run_day, count(*) AS n
FROM articles WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""",
}
