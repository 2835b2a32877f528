"""Vector and topic queries on the test tables with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import drop_words, tokens_unicode
from ..operators import topic_terms as TT
from ..operators.hierarchy import hdbscan
from ..operators.matching import match_topics
from ..operators.neighbours import knn_graph
from ..operators.vectors import (fit_reduction, fit_text_vectors, hashed_embedding, join_vectors, reduce_dims,
                                 text_vectors, vector_terms)
from ..plans import topics as P
from ..session import written
from . import views as V
from .views import SQL_ARTICLES, documents, sql_list, table

DIMS, EPS, MIN_PTS, FINENESS = 3, 0.06, 5, 4  # clusters of the test vectors
SCALE = 4_500_000.0                           # millionths, and the spread of a sum of about 21 components
WIDTH = 64                                    # of hashed text vectors


def _docs(spark: SparkSession, d: str) -> DataFrame:
    words = drop_words(tokens_unicode("summary"), V.STOP, 3)
    return V.articles(spark, d, topic=True).select("doc_id", "topic", "summary", words.alias("tokens"))


def _terms(spark: SparkSession, d: str) -> DataFrame:
    return TT.topic_terms(_docs(spark, d), "topic", "tokens")


def topic_terms(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).select("topic", "term", "rank", F.round("weight", 9).alias("weight"))


def representatives(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    chosen = TT.representative_docs(docs, "doc_id", "topic", "tokens", TT.topic_terms(docs, "topic", "tokens"))
    return chosen.select("topic", "doc_id", "rank", F.round("score", 6).alias("score"))


def topic_info(spark: SparkSession, d: str) -> DataFrame:
    info = P.topic_info(_docs(spark, d), "doc_id", "topic", "tokens", "summary")
    return info.select("Topic", "Count", "Name", F.array_join("Representation", "|").alias("Representation"),
                       F.array_join("Representative_Docs", "|").alias("Representative_Docs"))


def _embedded(spark: SparkSession, d: str, width: int = WIDTH) -> DataFrame:
    return documents(spark, d).select("doc_id", hashed_embedding(tokens_unicode("text"), width).alias("embedding"))


def embed_text(spark: SparkSession, d: str) -> DataFrame:
    values = F.posexplode("embedding").alias("bucket", "value")
    return (_embedded(spark, d).select("doc_id", values).where(F.col("value") != 0)
            .select("doc_id", "bucket", F.round(F.col("value").cast("double"), 6).alias("value")))


def doc_vector_join(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")
    joined = join_vectors(table(spark, d, "documents").select("doc_id", "lang"), vectors, "doc_id")
    return joined.select("doc_id", "lang", "label", F.size("embedding").alias("width"),
                         F.round(F.element_at("embedding", 1).cast("double"), 6).alias("first_value"))


def vector_load(spark: SparkSession, d: str) -> DataFrame:
    values = F.posexplode("embedding").alias("position", "value")
    return table(spark, d, "embeddings").select("vec_id", values).select(
        "vec_id", "position", F.round(F.col("value").cast("double"), 6).alias("value"))


def _low_dimensional(spark: SparkSession, d: str) -> DataFrame:
    """All components in 3 sums of every third, in whole millionths so that both sides add alike."""
    def total(start: int):
        part = F.filter("embedding", lambda x, i: i % DIMS == start)
        whole = F.transform(part, lambda x: F.floor(x.cast("double") * 1_000_000).cast("long"))
        return F.aggregate(whole, F.lit(0).cast("long"), lambda a, x: a + x).cast("double") / SCALE

    return table(spark, d, "embeddings").select("vec_id", F.array(*[total(i) for i in range(DIMS)]).alias("coords"))


def assign_topics(spark: SparkSession, d: str) -> DataFrame:
    rows = _low_dimensional(spark, d)
    points = P.numbered_points(rows, "vec_id", "coords", DIMS, EPS, MIN_PTS, MIN_PTS, FINENESS)
    return P.assign_points(rows, "coords", points, DIMS, EPS, FINENESS).select("vec_id", "topic")


def assign_shifted(spark: SparkSession, d: str) -> DataFrame:
    """Topics of every point moved by eps / 8 along each axis, from the model fitted on the unmoved points: most land
    on lattice points the fit did not see and take the nearest core point's topic."""
    rows = _low_dimensional(spark, d)
    points = P.numbered_points(rows, "vec_id", "coords", DIMS, EPS, MIN_PTS, MIN_PTS, FINENESS)
    moved = rows.select("vec_id", F.transform("coords", lambda x: x + F.lit(EPS / 8)).alias("coords"))
    return P.assign_points(moved, "coords", points, DIMS, EPS, FINENESS).select("vec_id", "topic")


def topic_identity(spark: SparkSession, d: str) -> DataFrame:
    """Topics of a second clustering (eps larger by a quarter) renamed to the first one's ids by shared vectors."""
    rows = _low_dimensional(spark, d)
    runs = []
    for eps in (EPS, EPS * 1.25):
        points = P.numbered_points(rows, "vec_id", "coords", DIMS, eps, MIN_PTS, MIN_PTS, FINENESS)
        runs.append(written(P.assign_points(rows, "coords", points, DIMS, eps, FINENESS).select("vec_id", "topic")))
    return match_topics(runs[0], runs[1], "vec_id").select("vec_id", "topic", "fresh_topic")


def tfidf_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Fitted TF-IDF vectors of the documents (terms in at least 5 % of them), as (doc_id, term, weight)."""
    docs = documents(spark, d).select("doc_id", tokens_unicode("text").alias("tokens"))
    model = fit_text_vectors(docs, "tokens", 0.05)
    return vector_terms(model, text_vectors(model, docs, "tokens"), "doc_id").select(
        "doc_id", "term", F.round("weight", 5).alias("weight"))


def density_cluster(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the clusters and of the outliers, with the least vector of each."""
    return assign_topics(spark, d).groupBy("topic").agg(
        F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("first_vec"), F.sum("vec_id").alias("vec_sum"))


def reduced(spark: SparkSession, d: str) -> DataFrame:
    """Coordinates by principal components; the SQL side has no eigenvectors to compare with."""
    vectors = table(spark, d, "embeddings")
    return reduce_dims(fit_reduction(vectors), vectors).select("vec_id", F.size("coords").alias("width"), "coords")


def fitted(spark: SparkSession, d: str) -> DataFrame:
    """Topics of the documents found from their words: embed, reduce, cluster, number."""
    vectors = written(_embedded(spark, d))
    model = P.fit_topics(vectors, "doc_id")
    return model.assign(vectors).groupBy("topic").agg(F.count(F.lit(1)).alias("count"))


def neighbour_graph(spark: SparkSession, d: str) -> DataFrame:
    """15 nearest neighbours by cosine of every embedding (NN-descent; recall against exact kNN in the tests)."""
    return knn_graph(table(spark, d, "embeddings"), "vec_id", "embedding", k=15).select(
        F.col("u").alias("vec_id"), F.col("v").alias("neighbour"), "rank", F.round("d", 6).alias("distance"))


def hdbscan_topics(spark: SparkSession, d: str) -> DataFrame:
    """HDBSCAN (eom, min_cluster_size 5) of the low-dimensional points, without eps."""
    return hdbscan(_low_dimensional(spark, d), "vec_id", "coords", min_cluster_size=MIN_PTS).select(
        F.col("id").alias("vec_id"), F.col("cluster").alias("topic"))


QUERIES = {
    "topic_terms": topic_terms,
    "topic_name": lambda s, d: TT.topic_names(TT.term_lists(_terms(s, d))),
    "representative_docs": representatives,
    "topic_info": topic_info,
    "embed_text": embed_text,
    "doc_vector_join": doc_vector_join,
    "vector_load": vector_load,
    "reduce_dims": reduced,
    "density_cluster": density_cluster,
    "assign_topics": assign_topics,
    "fit_topics": fitted,
    "neighbour_graph": neighbour_graph,
    "hdbscan_topics": hdbscan_topics,
    "assign_shifted": assign_shifted,
    "topic_identity": topic_identity,
    "tfidf_vectors": tfidf_vectors,
}

_TERMS = rf"""WITH {SQL_ARTICLES},
tok AS (SELECT doc_id, topic, summary, list_filter(regexp_extract_all(lower(summary), '\p{{L}}+'),
  lambda w: length(w) >= 3 AND NOT list_contains({sql_list(V.STOP)}, w)) AS toks FROM articles),
words AS (SELECT doc_id, topic, unnest(toks) AS term FROM tok WHERE topic IS NOT NULL),
counts AS (SELECT topic, term, count(*) AS tf FROM words GROUP BY ALL),
lens AS (SELECT topic, sum(tf) AS len FROM counts GROUP BY topic),
totals AS (SELECT term, sum(tf) AS total FROM counts GROUP BY term),
weights AS (SELECT topic, term, tf / len * ln(1 + (SELECT sum(len) / count(*) FROM lens) / total) AS weight
  FROM counts JOIN lens USING (topic) JOIN totals USING (term)),
terms AS (SELECT topic, term, weight, row_number() OVER (PARTITION BY topic ORDER BY round(weight, 12) DESC, term) AS rank
  FROM weights QUALIFY rank <= 10),
docs AS (SELECT topic, doc_id, row_number() OVER (PARTITION BY topic ORDER BY score DESC, doc_id) AS rank, score FROM (
  SELECT topic, doc_id, round(coalesce(sum(weight), 0), 9) AS score FROM tok
  LEFT JOIN (SELECT DISTINCT doc_id, topic, term, weight FROM words JOIN terms USING (topic, term)) h USING (doc_id, topic)
  WHERE topic IN (SELECT topic FROM terms) GROUP BY ALL) QUALIFY rank <= 3),
names AS (SELECT topic, topic || '_' || string_agg(term, '_' ORDER BY rank) FILTER (WHERE rank <= 4) AS name,
  string_agg(term, '|' ORDER BY rank) AS representation FROM terms GROUP BY topic)"""

_CLUSTERS = f"""WITH RECURSIVE pts AS (
  SELECT vec_id, list_transform(range(0, {DIMS}), lambda k: CAST(floor(
    CAST(list_sum(list_transform(list_filter(embedding, lambda x, i: (i - 1) % {DIMS} = k),
      lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT))) AS DOUBLE) / {SCALE}
    / ({EPS} / ({FINENESS} * {DIMS} ** 0.5))) AS BIGINT)) AS p FROM embeddings),
lat AS (SELECT p, count(*) AS w, min(vec_id) AS first_vec, list_transform(p, lambda x:
    CAST(floor(x / {FINENESS}.0) AS BIGINT)) AS cell FROM pts GROUP BY p),
near AS (SELECT a.p AS p, a.cell AS cell, b.p AS q, b.cell AS qcell, b.w AS qw,
    {' + '.join(f'(a.p[{i}] - b.p[{i}]) * (a.p[{i}] - b.p[{i}])' for i in range(1, DIMS + 1))} AS dist
  FROM lat a JOIN lat b ON {' + '.join(f'(a.p[{i}] - b.p[{i}]) * (a.p[{i}] - b.p[{i}])' for i in range(1, DIMS + 1))}
    <= {DIMS * FINENESS * FINENESS}),
core AS (SELECT p, any_value(cell) AS cell FROM near GROUP BY p HAVING sum(qw) >= {MIN_PTS}),
edges AS (SELECT DISTINCT cell AS u, qcell AS v FROM near WHERE p IN (SELECT p FROM core) AND q IN (SELECT p FROM core)),
reach(u, v) AS (SELECT u, v FROM edges UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u),
comp AS (SELECT u AS cell, min(v) AS component FROM reach GROUP BY u),
labels AS (
  SELECT p, component FROM core JOIN comp USING (cell)
  UNION ALL
  SELECT p, component FROM (SELECT p, component, row_number() OVER (PARTITION BY p ORDER BY dist, component) AS rn
    FROM near JOIN comp ON comp.cell = qcell WHERE q IN (SELECT p FROM core) AND p NOT IN (SELECT p FROM core))
  WHERE rn = 1),
numbered AS (SELECT component, row_number() OVER (ORDER BY sum(w) DESC, min(first_vec)) - 1 AS topic
  FROM labels JOIN lat USING (p) GROUP BY component HAVING sum(w) >= {MIN_PTS}),
assigned AS (SELECT vec_id, CAST(coalesce(topic, -1) AS INTEGER) AS topic
  FROM pts LEFT JOIN labels USING (p) LEFT JOIN numbered USING (component))"""

ORACLES = {
    "topic_terms": f"{_TERMS} SELECT topic, term, CAST(rank AS INTEGER) AS rank, round(weight, 9) AS weight FROM terms",
    "topic_name": f"{_TERMS} SELECT topic, name FROM names",
    "representative_docs": f"{_TERMS} SELECT topic, doc_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM docs",
    "topic_info": f"""{_TERMS}
SELECT a.topic AS "Topic", a.n AS "Count", name AS "Name", representation AS "Representation", titles AS "Representative_Docs"
FROM (SELECT topic, count(*) AS n FROM articles GROUP BY topic) a LEFT JOIN names USING (topic)
LEFT JOIN (SELECT topic, string_agg(summary, '|' ORDER BY rank) AS titles FROM docs JOIN tok USING (topic, doc_id)
           GROUP BY topic) t USING (topic)""",
    "tfidf_vectors": r"""WITH toks AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\p{L}+') AS t FROM documents),
m AS (SELECT count(*) AS m FROM toks),
words AS (SELECT doc_id, unnest(t) AS term FROM toks),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
kept AS (SELECT term, ln((m + 1.0) / (df + 1.0)) AS idf FROM df, m WHERE df >= 0.05 * m),
w AS (SELECT doc_id, term, tf * idf AS x FROM tf JOIN kept USING (term)),
n AS (SELECT doc_id, sqrt(sum(x * x)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, term, round(CAST(CAST(x / norm AS FLOAT) AS DOUBLE), 5) AS weight FROM w JOIN n USING (doc_id)
WHERE x <> 0 AND norm > 0""",
    "embed_text": rf"""WITH words AS (SELECT doc_id, md5(unnest(regexp_extract_all(lower(text), '\p{{L}}+'))) AS h FROM documents),
codes AS (SELECT doc_id, CAST('0x' || substr(h, 1, 8) AS BIGINT) % {2 * WIDTH} AS code FROM words),
sums AS (SELECT doc_id, CAST(code // 2 AS INTEGER) AS bucket,
  sum(CASE WHEN code % 2 = 1 THEN 1 ELSE -1 END)::DOUBLE AS v FROM codes GROUP BY ALL)
SELECT doc_id, bucket, round(CAST(CAST(v / norm AS FLOAT) AS DOUBLE), 6) AS value
FROM sums JOIN (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM sums GROUP BY doc_id) USING (doc_id) WHERE v <> 0""",
    "doc_vector_join": """SELECT d.doc_id, d.lang, e.label, CAST(len(e.embedding) AS INTEGER) AS width,
  round(CAST(e.embedding[1] AS DOUBLE), 6) AS first_value FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id""",
    "vector_load": """SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, round(CAST(x AS DOUBLE), 6) AS value
FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)""",
    "density_cluster": f"""{_CLUSTERS} SELECT topic, count(*) AS size, min(vec_id) AS first_vec,
  CAST(sum(vec_id) AS BIGINT) AS vec_sum FROM assigned GROUP BY topic""",
    "assign_topics": f"{_CLUSTERS} SELECT vec_id, topic FROM assigned",
}
