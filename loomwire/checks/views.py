"""The test tables in the shape of the library's inputs, in Spark and as SQL.

Only the joins which a query needs are part of its view: time and topic cost a join each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strip_space

# category, keyword
SEED = (("texture", "thatin"), ("texture", "Ononst"), ("shape", "inoran"), ("shape", "hehely"),
        ("event", "orantion"), ("event", "thatin"), ("brand", "EAUX"), ("common", "tion"),
        ("common", "ment"), ("unused", "zzqx"))
STOP = tuple("the and that with this from for les der und des que est los las por pour dans ein den".split())
PHRASES = ("thatin", "tion ment", "zzqx", "a b c")
SHOP = "https://shop.example.com"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def seed(spark: SparkSession) -> DataFrame:
    rows = [(i, c, k) for i, (c, k) in enumerate(SEED)]
    return spark.createDataFrame(rows, "ord int, category string, keyword string")


def articles(spark: SparkSession, sf_dir: str, time: bool = False, topic: bool = False) -> DataFrame:
    docs = documents(spark, sf_dir)
    link = F.when(F.col("doc_id") % 3 == 0, "").otherwise(
        F.concat(F.lit("https://www."), "source", F.lit(".example.com/a/"), F.col("doc_id").cast("string")))
    view = docs.select("doc_id", strip_space(F.substring_index("text", "\n", 1)).alias("title"),
                       F.col("text").alias("summary"), link.alias("link"), "lang")
    if time:
        events = table(spark, sf_dir, "events")
        step = events.count() // table(spark, sf_dir, "documents").count()
        times = events.select("event_id", F.col("ts").alias("ingested_at"))
        view = view.join(times, F.col("doc_id") * step == F.col("event_id"), "left").drop("event_id")
    if topic:
        vectors = table(spark, sf_dir, "embeddings")
        n = vectors.count()
        view = view.join(vectors.select("vec_id", F.col("label").alias("topic")),
                         F.col("doc_id") % n == F.col("vec_id"), "left").drop("vec_id")
    return view


def title_of(html: str) -> F.Column:
    return F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    designer = F.regexp_extract("url", r"([^./]+)\.example\.", 1)
    return pages(spark, sf_dir).select("page_id", "url", designer.alias("designer"), title_of("html").alias("title"))


# --- the same in SQL ---------------------------------------------------------------------------

def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(words) -> str:
    return "[" + ", ".join(quote(w) for w in words) + "]"


SPACE = r"[\s\p{Z}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_unescape(x: str) -> str:
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"replace({x}, '&{name};', {quote(char)})"
    return x


_TAG = r"""</?[A-Za-z](?:[^''">]+|"[^"]*"|''[^'']*'')*>|<[!?][^>]*>"""
_INVISIBLE = r"<!--.*?-->|<script\b.*?(?:</script[^>]*>|\z)|<style\b.*?(?:</style[^>]*>|\z)"


def sql_text(html: str) -> str:
    marked = rf"regexp_replace({html}, '(?is){_INVISIBLE}|{_TAG}', chr(1), 'g')"
    return sql_strip(sql_unescape(rf"regexp_replace({marked}, '\x01+', ' ', 'g')"))


SQL_SEED = ("seed(ord, category, keyword) AS (VALUES "
            + ", ".join(f"({i}, {quote(c)}, {quote(k)})" for i, (c, k) in enumerate(SEED)) + ")")

SQL_ARTICLES = rf"""articles AS (
  SELECT d.doc_id, {sql_strip("split_part(d.text, chr(10), 1)")} AS title, d.text AS summary,
         CASE WHEN d.doc_id % 3 = 0 THEN ''
              ELSE 'https://www.' || d.source || '.example.com/a/' || d.doc_id END AS link,
         d.lang, e.ts AS ingested_at, v.label AS topic
  FROM documents d
  LEFT JOIN events e ON e.event_id = d.doc_id * ((SELECT count(*) FROM events) // (SELECT count(*) FROM documents))
  LEFT JOIN embeddings v ON v.vec_id = d.doc_id % (SELECT count(*) FROM embeddings))"""

SQL_PRODUCTS = r"""products AS (
  SELECT page_id, url, regexp_extract(url, '([^./]+)\.example\.', 1) AS designer,
         regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM pages)"""

# articles with a time, last copy kept, with source and week
SQL_KEPT = SQL_ARTICLES + r""",
kept AS (
  SELECT doc_id, title, CAST(topic AS VARCHAR) AS topic, ingested_at,
         replace(lower(regexp_extract(link, '://([^/?#]*)', 1)), 'www.', '') AS source,
         strftime(ingested_at, '%Y-%W') AS year_week
  FROM (SELECT *, row_number() OVER (PARTITION BY link, title, topic ORDER BY ingested_at DESC, doc_id DESC) AS rn
        FROM articles WHERE ingested_at IS NOT NULL)
  WHERE rn = 1),
weekly AS (SELECT topic, year_week, source, count(*) AS n FROM kept GROUP BY ALL),
weeks AS (SELECT year_week, row_number() OVER (ORDER BY year_week DESC) AS k
          FROM (SELECT DISTINCT year_week FROM kept))"""


def sql_metrics(latest: int = 1) -> str:
    return f"""metrics{latest if latest > 1 else ''} AS (
  SELECT *, (this - prev) / greatest(1, prev) AS velocity, 2 * this + prev AS recency FROM (
    SELECT topic, CAST(coalesce(sum(CASE WHEN k = {latest} THEN n END), 0) AS BIGINT) AS this,
           CAST(coalesce(sum(CASE WHEN k = {latest + 1} THEN n END), 0) AS BIGINT) AS prev,
           count(DISTINCT CASE WHEN k = {latest} THEN source END) AS sources
    FROM weekly JOIN weeks USING (year_week) WHERE k >= {latest} GROUP BY topic))"""


def sql_norm(x: str) -> str:
    return f"coalesce(({x} - min({x}) OVER ()) / nullif(CAST(max({x}) OVER () - min({x}) OVER () AS DOUBLE), 0), 0)"


def sql_scores(latest: int = 1) -> str:
    n = latest if latest > 1 else ""
    return f"""scores{n} AS (
  SELECT *, 100 * (0.4 * velocity_norm + 0.3 * recency_norm + 0.3 * source_norm) AS trend_score FROM (
    SELECT *, {sql_norm('clipped')} AS velocity_norm, {sql_norm('recency')} AS recency_norm,
           {sql_norm('sources')} AS source_norm
    FROM (SELECT *, greatest(-5.0, least(5.0, velocity)) AS clipped FROM metrics{n})))"""


SQL_HEADLINES = """headlines AS (
  SELECT topic, string_agg(title, ' || ' ORDER BY r) AS rep_headlines FROM (
    SELECT topic, title, row_number() OVER (PARTITION BY topic ORDER BY min(ingested_at), min(doc_id)) AS r
    FROM kept JOIN weeks USING (year_week) WHERE k = 1 AND title IS NOT NULL GROUP BY topic, title)
  WHERE r <= 3 GROUP BY topic)"""


def sql_tokens_strip(text: str, stop=(), min_length: int = 1) -> str:
    words = rf"regexp_split_to_array(lower(regexp_replace({text}, '[^a-zA-Z\s\p{{Z}}]', '', 'g')), '{SPACE}+')"
    wanted = f"length(w) >= {min_length}" + (f" AND NOT list_contains({sql_list(stop)}, w)" if stop else "")
    return f"list_filter({words}, lambda w: {wanted})"


def sql_tokens_regex(text: str, stop=(), min_length: int = 1) -> str:
    words = rf"regexp_extract_all(lower({text}), '[a-z'']+')"
    wanted = f"length(w) >= {min_length}" + (f" AND NOT list_contains({sql_list(stop)}, w)" if stop else "")
    return f"list_filter({words}, lambda w: {wanted})"


SQL_BOTH = "(coalesce(title, '') || ' ' || coalesce(summary, ''))"


def sql_words(tokens: str, key: str, source: str) -> str:
    """tok (one row per document) and words (one row per word with its position)."""
    return (f"tok AS (SELECT {key}, {tokens} AS toks FROM {source}),\n"
            f"words AS (SELECT {key}, unnest(toks) AS term, generate_subscripts(toks, 1) AS pos FROM tok)")
