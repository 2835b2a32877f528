"""The ten operators as queries on the whole test tables, and SQL for the rows where SQL can tell them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_folder
from . import (backoff, compression, digest_tree, disclosure, language, line_dedup, mixing, packing, spelling,
               superminhash, token_files, warc, whitening)

VOCABULARY = "word_bpe_49k.json"


def tokenizer() -> str:
    """The public vocabulary file, at the same path on every machine."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.quality(table(spark, sf_dir, "documents"))


def op2_digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_tree.duplicates(table(spark, sf_dir, "documents"), best="largest")


def op3_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


def op4_line_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document with a line that was first somewhere: the numbers of the lines that stay, and of those that go
    as copies by one word."""
    found = line_dedup.line_verdicts(table(spark, sf_dir, "documents"))
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return found.select("doc_id", F.size("kept").cast("long").alias("n_kept"), F.size("near").cast("long").alias("n_near"),
                        joined("kept").alias("kept"), joined("near").alias("near"))


def op5_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Target weights of the mix; names not listed weigh 1.
WEIGHTS = {"lang": {"en": 6, "de": 2, "fr": 2, "es": 2}, "domain": {"domain0": 3, "domain1": 2, "domain2": 2}}


def mix_levels() -> dict[str, Column]:
    """domain, a group of sources by their number; language; source."""
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int)")
    return {"domain": F.concat(F.lit("domain"), (number % 4).cast("string")), "lang": F.col("lang"),
            "source": F.col("source")}


def op6_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mix_levels(), WEIGHTS, share=(4, 5), epochs=2, seed=7)


def op7_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.backoff_scores(table(spark, sf_dir, "documents"))


def op8_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.find(table(spark, sf_dir, "documents"))

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    terms = F.transform("disclosing", lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"),
                                                         s["end"].alias("end")))
    return found.select("doc_id", *[count(k) for k in disclosure.KINDS], F.sha2(told(F.col("base")), 256).alias("base_sha256"),
                        told(F.concat("base", terms)).alias("spans"))


def op9_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer(), end_id=2)
    return token_files.checked_token_files(spark, path)


def op10_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op12_fst_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_compression_bands, op2_digest_tree, op3_ordered_packing, op4_line_neighbours,
                            op5_warc_segments, op6_tree_mix, op7_backoff_scores, op8_disclosure, op9_orc_tokens,
                            op10_superminhash, op11_centroid_language, op12_fst_spelling, op13_feast_whitening)}

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _sql_weight(level: str) -> str:
    cases = "".join(f" WHEN '{value}' THEN {number}" for value, number in WEIGHTS.get(level, {}).items())
    return f"CASE {level}{cases} ELSE 1 END" if cases else "1"


def _sql_settled(depth: int, levels: list[str]) -> str:
    """Budgets of the nodes at a depth, from those of their parents."""
    path, level = levels[:depth], levels[depth]
    same = " AND ".join(["true", *[f"n.{p} IS NOT DISTINCT FROM t.{p}" for p in path]])
    parts = ", ".join(path) or "1"
    order = f"PARTITION BY {parts} ORDER BY capacity::DOUBLE / weight, {level} NULLS FIRST"
    return f"""nodes{depth} AS (SELECT n.*, {_sql_weight(level)} AS weight, t.budget FROM (
  SELECT {', '.join([*path, level])}, CAST(sum(capacity) AS HUGEINT) AS capacity FROM leaves GROUP BY ALL) n JOIN tree{depth} t ON {same}),
shares{depth} AS (SELECT *, row_number() OVER ({order}) AS rn,
  greatest(budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS room,
  sum(weight) OVER (PARTITION BY {parts})
    - coalesce(sum(weight) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM nodes{depth}),
level{depth} AS (SELECT *, min(CASE WHEN capacity * rest > room * weight THEN rn END) OVER (PARTITION BY {parts}) AS cut FROM shares{depth}),
tree{depth + 1} AS (SELECT {', '.join([*path, level])}, CASE WHEN cut IS NULL OR rn < cut THEN capacity ELSE least(capacity,
  max(CASE WHEN rn = cut THEN room END) OVER (PARTITION BY {parts}) * weight
  // max(CASE WHEN rn = cut THEN rest END) OVER (PARTITION BY {parts})) END AS budget FROM level{depth})"""


def _sql_mix(share: tuple[int, int], epochs: int, seed: int) -> str:
    levels = ["domain", "lang", "source"]
    steps = ",\n".join(_sql_settled(i, levels) for i in range(3))
    return f"""WITH docs AS (SELECT doc_id, 'domain' || CAST(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 4 AS VARCHAR) AS domain,
  lang, source, CAST(coalesce(len({WORDS.format('text')}), 0) AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens, CAST(sum(n_tokens) * {epochs} AS HUGEINT) AS capacity
  FROM docs GROUP BY ALL),
tree0 AS (SELECT least(sum(tokens) * {share[0]} // {share[1]}, sum(capacity)) AS budget FROM leaves),
{steps},
plan AS (SELECT l.domain, l.lang, l.source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
  CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS room FROM leaves l JOIN tree3 t ON l.domain IS NOT DISTINCT FROM t.domain
  AND l.lang IS NOT DISTINCT FROM t.lang AND l.source IS NOT DISTINCT FROM t.source),
placed AS (SELECT d.*, whole, room, coalesce(sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source
  ORDER BY md5('{seed}:' || CAST(whole AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, n_tokens
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM docs d JOIN plan p ON d.domain IS NOT DISTINCT FROM p.domain
  AND d.lang IS NOT DISTINCT FROM p.lang AND d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, domain, lang, source, n_tokens, CAST(whole + CASE WHEN before + n_tokens <= room THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM placed"""


ORACLES: dict[str, str] = {
    "op2_digest_tree": """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(plain) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain FROM documents)
WINDOW same AS (PARTITION BY plain)""",
    "op4_line_neighbours": f"""WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(range(len(parts))) AS line, {WORDS.format('unnest(parts)')} AS w FROM cut),
firsts AS (SELECT w, min(doc_id::HUGEINT * 2147483648 + line) AS place FROM lines WHERE len(w) > 0 GROUP BY w),
able AS (SELECT * FROM firsts WHERE len(w) >= 8),
variants AS (SELECT place, i, list_concat(w[1:i - 1], w[i + 1:]) AS key FROM (SELECT place, w, unnest(range(1, len(w) + 1)) AS i FROM able)),
near AS (SELECT place FROM variants JOIN (SELECT key, i, min(place) AS m FROM variants GROUP BY ALL) USING (key, i) WHERE m < place
  UNION SELECT v.place FROM variants v JOIN able a ON v.key = a.w WHERE a.place < v.place
  UNION SELECT a.place FROM able a JOIN (SELECT key, min(place) AS m FROM variants GROUP BY key) k ON k.key = a.w WHERE k.m < a.place),
found AS (SELECT place // 2147483648 AS doc_id, place % 2147483648 AS line, place IN (SELECT place FROM near) AS goes FROM firsts)
SELECT CAST(doc_id AS BIGINT) AS doc_id, count(*) FILTER (WHERE NOT goes) AS n_kept, count(*) FILTER (WHERE goes) AS n_near,
  coalesce(string_agg(line, ',' ORDER BY line) FILTER (WHERE NOT goes), '') AS kept,
  coalesce(string_agg(line, ',' ORDER BY line) FILTER (WHERE goes), '') AS near FROM found GROUP BY doc_id""",
    "op5_warc_segments": """SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32),
    lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT)
    >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)""",
    "op6_tree_mix": _sql_mix((4, 5), 2, 7),
}
