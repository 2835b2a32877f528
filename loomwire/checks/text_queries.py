"""Keyword, token, count and search queries on the test tables with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text as T
from ..functions.stopwords import ENGLISH
from ..operators import counts as C
from ..operators import keywords as K
from ..operators.lemmas import clean_with_lemmas
from ..operators.qgram_search import search_terms
from ..operators.search import search_articles
from ..plans.frequencies import corpus_tokens, frequency_tables
from . import views as V
from .views import (SQL_ARTICLES, SQL_BOTH, SQL_SEED, sql_list, sql_tokens_regex, sql_tokens_strip,
                    sql_words)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return V.documents(spark, d).select("doc_id", "text", "lang")


def _matched(spark: SparkSession, d: str) -> DataFrame:
    return K.with_matches(V.articles(spark, d), T.search_text(), V.seed(spark))


def _long_seed(spark: SparkSession, d: str) -> DataFrame:
    """Every 10th document's first word as a keyword, with repeats, nulls in category and a null keyword."""
    word = F.regexp_extract("text", r"^[^\x20\x09-\x0D]+", 0)
    docs = _docs(spark, d).where("doc_id % 10 = 0 OR doc_id < 600")
    return docs.select(F.col("doc_id").alias("ord"), F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("category"),
                       F.when(F.col("doc_id") % 50 > 0, word).alias("keyword"))


def long_list(spark: SparkSession, d: str) -> DataFrame:
    """A long list derived from the documents, against texts of which some share a key or have none."""
    matched = K.with_matches(_docs(spark, d), F.lower("text"), _long_seed(spark, d))
    return matched.select("doc_id", F.array_join("matched_keywords", "|").alias("keywords"),
                          F.array_join("tags", ",").alias("tags"))


def lemma_text(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary of all words of the documents that end in s, without it."""
    words = C.term_rows(_docs(spark, d).select(T.tokens_unicode("text").alias("tokens")), "tokens").distinct()
    endings = words.where("length(term) > 4 AND endswith(term, 's')").select(
        F.col("term").alias("word"), F.expr("substring(term, 1, length(term) - 1)").alias("lemma"))
    return clean_with_lemmas(_docs(spark, d), "doc_id", "text", endings, V.STOP)


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return corpus_tokens(V.articles(spark, d), "doc_id")


def _listed(df: DataFrame, tokens) -> DataFrame:
    """Token arrays as their size and one text."""
    return df.select("doc_id", F.size(tokens).alias("n"), F.array_join(tokens, " ").alias("tokens"))


def _with_rank(top: DataFrame) -> DataFrame:
    ties = [c for c in ("first_seen", "term") if c in top.columns]
    rank = F.row_number().over(Window.orderBy(F.desc("count"), *ties))
    return top.select(rank.alias("rank"), "term", "count")


def round_trip(spark: SparkSession, d: str) -> DataFrame:
    joined = _matched(spark, d).select("doc_id", T.join_list("matched_keywords").alias("joined"))
    parts = T.split_list("joined")
    return joined.select("doc_id", "joined", F.size(parts).alias("n"), T.join_list(parts, "|").alias("parts"))


def stopword_filter(spark: SparkSession, d: str) -> DataFrame:
    return _listed(_docs(spark, d), T.drop_words(T.tokens_strip("text"), V.STOP, 3))


def stopword_anti(spark: SparkSession, d: str) -> DataFrame:
    """The table form of the stop filter: an anti join; Spark sees that the list is small."""
    stop = spark.createDataFrame([(w,) for w in V.STOP], "term string")
    words = C.term_rows(_docs(spark, d).select(T.tokens_strip("text").alias("tokens")), "tokens")
    return words.join(stop, "term", "left_anti").groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def inner_pairs(spark: SparkSession, d: str) -> DataFrame:
    pairs = T.bigrams(T.tokens_strip("text"))
    return _docs(spark, d).select("doc_id", F.size(pairs).alias("n"), F.array_join(pairs, "|").alias("pairs"))


def corpus_pairs(spark: SparkSession, d: str) -> DataFrame:
    return C.pair_counts(_tokens(spark, d), "tokens", "doc_id", cross_document=True).select("term", "count")


def sheets(spark: SparkSession, d: str) -> DataFrame:
    tables = frequency_tables(V.articles(spark, d), "doc_id", 50)
    return (tables["words"].selectExpr("'words' AS sheet", "Word AS entry", "Count AS n")
            .unionByName(tables["bigrams"].selectExpr("'bigrams' AS sheet", "Bigram AS entry", "Count AS n")))


def search_term_table(spark: SparkSession, d: str) -> DataFrame:
    """Every word of the benchmark passages, as a term table, against every article, through the q-gram postings."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), 0)
    terms = V.table(spark, d, "benchmark").select(F.explode(words).alias("term")).distinct()
    return search_terms(V.articles(spark, d), "doc_id", T.search_text(), terms, "term", "term").select("term", "doc_id")


def search(spark: SparkSession, d: str) -> DataFrame:
    return search_articles(V.articles(spark, d), V.PHRASES, keep=("doc_id", "link"))


QUERIES = {
    "keyword_match": lambda s, d: _matched(s, d).select("doc_id", T.join_list("matched_keywords").alias("matched_keywords")),
    "category_tags": lambda s, d: _matched(s, d).select("doc_id", F.array_join("tags", ", ").alias("tags")),
    "keyword_article_join": lambda s, d: K.keyword_pairs(
        V.articles(s, d), "doc_id", T.search_text(), V.seed(s)).select("doc_id", "category", "keyword"),
    # by whole rows, without a key
    "keyword_gram_join": lambda s, d: K.with_seeds(V.articles(s, d), T.search_text(), V.seed(s)).select(
        "doc_id", F.inline("_seeds")).select("doc_id", "category", "keyword"),
    "keyword_long_list": long_list,
    "keyword_frequencies": lambda s, d: K.keyword_frequencies(_matched(s, d)),
    "keyword_list_roundtrip": round_trip,
    "search_text": lambda s, d: V.articles(s, d).select("doc_id", F.md5(T.search_text()).alias("text_md5")),
    "tokens_strip": lambda s, d: _listed(_docs(s, d), T.tokens_strip("text")),
    "tokens_regex": lambda s, d: _listed(_docs(s, d), T.tokens_regex("text")),
    "clean_text": lambda s, d: _docs(s, d).select("doc_id", T.clean_text("text", V.STOP).alias("text_clean")),
    "clean_with_lemmas": lemma_text,
    "stopword_filter": stopword_filter,
    "stopword_anti": stopword_anti,
    "bigrams_within_doc": inner_pairs,
    "bigrams_corpus": corpus_pairs,
    "word_counts": lambda s, d: C.term_counts(_tokens(s, d), "tokens"),
    "bigram_counts": lambda s, d: C.pair_counts(_tokens(s, d), "tokens", "doc_id").select("term", "count"),
    "topk_words": lambda s, d: _with_rank(C.top_k(C.term_counts(_tokens(s, d), "tokens", "doc_id"), 50)),
    "topk_bigrams": lambda s, d: _with_rank(C.top_k(
        C.pair_counts(_tokens(s, d), "tokens", "doc_id", cross_document=True), 50)),
    "frequency_sheets": sheets,
    "search_articles": search,
    "search_term_table": search_term_table,
    "highlight": lambda s, d: _docs(s, d).select("doc_id", T.highlight("text", ["tion", "the."]).alias("marked")),
}

_TOK = sql_words(sql_tokens_strip(SQL_BOTH, ENGLISH, 3), "doc_id", "articles")
_FREQ = f"WITH {SQL_ARTICLES}, {_TOK}"
_MATCH = f"""WITH {SQL_ARTICLES}, {SQL_SEED},
found AS (SELECT doc_id, ord, category, keyword FROM articles JOIN seed ON contains(lower({SQL_BOTH}), lower(keyword)))"""
_PAIRS = """pairs AS (SELECT doc_id, pos, term || ' ' || lead(term) OVER ({part}ORDER BY doc_id, pos) AS term FROM words)"""
_INNER, _ACROSS = _PAIRS.format(part="PARTITION BY doc_id "), _PAIRS.format(part="")


def _sql_listed(tokens: str) -> str:
    return (f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(t, ' ') AS tokens "
            f"FROM (SELECT doc_id, {tokens} AS t FROM documents)")


def _sql_top(source: str, n: int) -> str:
    order = "count(*) DESC, min(doc_id * 33554432 + pos)"
    return (f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, term, count(*) AS count FROM {source} "
            f"WHERE term IS NOT NULL GROUP BY term ORDER BY {order} LIMIT {n}")


def _sql_mark(text: str, *patterns: str) -> str:
    for p in patterns:
        text = rf"regexp_replace({text}, '({p})', '[\1]', 'gi')"
    return text


ORACLES = {
    "keyword_match": f"""{_MATCH} SELECT doc_id, coalesce(string_agg(keyword, ', ' ORDER BY ord), '') AS matched_keywords
FROM articles LEFT JOIN found USING (doc_id) GROUP BY doc_id""",
    "category_tags": f"""{_MATCH} SELECT doc_id, coalesce(string_agg(category, ', ' ORDER BY category), '') AS tags
FROM articles LEFT JOIN (SELECT DISTINCT doc_id, category FROM found) USING (doc_id) GROUP BY doc_id""",
    "keyword_article_join": f"{_MATCH} SELECT doc_id, category, keyword FROM found",
    "keyword_gram_join": f"{_MATCH} SELECT doc_id, category, keyword FROM found",
    "keyword_long_list": r"""WITH seed AS (SELECT doc_id AS ord, CASE WHEN doc_id % 3 > 0 THEN lang END AS category,
  regexp_extract(text, '^[^\x20\x09-\x0D]+') AS keyword FROM documents
  WHERE (doc_id % 10 = 0 OR doc_id < 600) AND doc_id % 50 > 0 AND text IS NOT NULL),
found AS (SELECT d.doc_id, s.ord, s.category, s.keyword FROM documents d JOIN seed s ON contains(lower(d.text), lower(s.keyword)))
SELECT doc_id, coalesce(string_agg(keyword, '|' ORDER BY ord), '') AS keywords,
  coalesce(array_to_string(list_sort(list_distinct(list(category) FILTER (WHERE category IS NOT NULL))), ','), '') AS tags
FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id""",
    "keyword_frequencies": f"{_MATCH} SELECT keyword, count(*) AS count FROM found GROUP BY keyword",
    "keyword_list_roundtrip": f"""{_MATCH} SELECT doc_id, coalesce(string_agg(keyword, ', ' ORDER BY ord), '') AS joined,
  CAST(count(keyword) AS INTEGER) AS n, coalesce(string_agg(keyword, '|' ORDER BY ord), '') AS parts
FROM articles LEFT JOIN found USING (doc_id) GROUP BY doc_id""",
    "search_text": f"WITH {SQL_ARTICLES} SELECT doc_id, md5(lower({SQL_BOTH})) AS text_md5 FROM articles",
    "tokens_strip": _sql_listed(sql_tokens_strip("text")),
    "tokens_regex": _sql_listed(sql_tokens_regex("text")),
    "clean_text": f"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '\\p{{L}}+'),
  lambda w: length(w) >= 3 AND NOT list_contains({sql_list(V.STOP)}, w)), ' ') AS text_clean FROM documents""",
    "clean_with_lemmas": f"""SELECT doc_id, array_to_string(list_filter(list_transform(list_filter(
    regexp_extract_all(lower(coalesce(text, '')), '\\p{{L}}+'), lambda w: NOT list_contains({sql_list(V.STOP)}, w)),
  lambda w: CASE WHEN length(w) > 4 AND ends_with(w, 's') THEN left(w, -1) ELSE w END), lambda w: length(w) >= 3), ' ') AS text_clean
FROM documents""",
    "stopword_filter": _sql_listed(sql_tokens_strip("text", V.STOP, 3)),
    "stopword_anti": f"""WITH {sql_words(sql_tokens_strip("text"), "doc_id", "documents")}
SELECT term, count(*) AS count FROM words WHERE term NOT IN (SELECT unnest({sql_list(V.STOP)})) GROUP BY term""",
    "bigrams_within_doc": f"""WITH {sql_words(sql_tokens_strip("text"), "doc_id", "documents")}, {_INNER}
SELECT doc_id, CAST(count(p.term) AS INTEGER) AS n, coalesce(string_agg(p.term, '|' ORDER BY pos), '') AS pairs
FROM documents LEFT JOIN pairs p USING (doc_id) GROUP BY doc_id""",
    "bigrams_corpus": f"{_FREQ}, {_ACROSS} SELECT term, count(*) AS count FROM pairs WHERE term IS NOT NULL GROUP BY term",
    "word_counts": f"{_FREQ} SELECT term, count(*) AS count FROM words GROUP BY term",
    "bigram_counts": f"{_FREQ}, {_INNER} SELECT term, count(*) AS count FROM pairs WHERE term IS NOT NULL GROUP BY term",
    "topk_words": f"{_FREQ} {_sql_top('words', 50)}",
    "topk_bigrams": f"{_FREQ}, {_ACROSS} {_sql_top('pairs', 50)}",
    "frequency_sheets": f"""{_FREQ}, {_ACROSS}
SELECT 'words' AS sheet, term AS entry, count AS n FROM ({_sql_top('words', 50)})
UNION ALL SELECT 'bigrams', term, count FROM ({_sql_top('pairs', 50)})""",
    "search_term_table": f"""WITH {SQL_ARTICLES}, texts AS (SELECT doc_id, lower({SQL_BOTH}) AS t FROM articles),
terms AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{2,}}')) AS term FROM benchmark)
SELECT term, doc_id FROM terms JOIN texts ON contains(t, term)""",
    "search_articles": f"""WITH {SQL_ARTICLES}, texts AS (SELECT *, lower({SQL_BOTH}) AS t FROM articles)
SELECT 'thatin' AS phrase, title, {_sql_mark('summary', 'thatin')} AS summary, doc_id, link
FROM texts WHERE contains(t, 'thatin')
UNION ALL SELECT 'tion ment', title, {_sql_mark('summary', 'tion', 'ment')}, doc_id, link
FROM texts WHERE contains(t, 'tion') AND contains(t, 'ment')
UNION ALL SELECT 'zzqx', title, {_sql_mark('summary', 'zzqx')}, doc_id, link FROM texts WHERE contains(t, 'zzqx')""",
    "highlight": rf"SELECT doc_id, {_sql_mark('text', 'tion', 'the[.]')} AS marked FROM documents",
}
