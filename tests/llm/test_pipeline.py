"""The pipeline against a plain version built of the tests' brute-force pieces."""

import pyarrow.parquet as pq
import corpus_pipeline
from cases import SF, WORD, awkward, frame, multiset, rows_of
from loomwire.llm.queries import WEIGHTS, tokenizer
import test_lines
import test_mixing
import test_near
import test_packing
import test_quality


def stages(docs):
    """docs: id -> (text, lang, source); the documents after each of the first four stages."""
    docs = {d: x for d, x in docs.items() if not test_quality.plain(x[0])["base_failed"] and test_quality.verdict(x[0])}
    yield docs
    kept = {d: set(k) for d, (k, _) in test_lines.plain([(d, x[0]) for d, x in docs.items()]).items()}
    left = {}
    for d, (text, *rest) in docs.items():
        lines = [x for i, x in enumerate(text.split("\n")) if i in kept.get(d, ()) or not WORD.search(x)]
        if d in kept and kept[d]:
            left[d] = ("\n".join(lines), *rest)
    yield left
    alone = {d for d, _, _, k in test_near.plain([(d, x[0]) for d, x in left.items()]) if k}
    left = {d: x for d, x in left.items() if d in alone}
    yield left
    rows = [(d, (test_mixing.domain(s), lang, s), len(WORD.findall(t))) for d, (t, lang, s) in left.items()]
    taken = test_mixing.plain(rows, WEIGHTS, ["domain", "lang", "source"], (4, 5), 1, 7)
    copies = {r[0]: r[-1] for r in taken}
    yield {d: x for d, x in left.items() if copies[d] > 0}


def test_all_documents(spark, tmp_path):
    from tokenizers import Tokenizer
    docs = {r["doc_id"]: (r["text"], r["lang"], r["source"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    df = spark.read.parquet(f"{SF}/documents.parquet")
    columns = df.columns
    for i, ((_, stage), expected) in enumerate(zip(corpus_pipeline.STAGES, stages(docs))):
        stage(spark, df, SF).write.parquet(str(tmp_path / str(i)))
        df = spark.read.parquet(str(tmp_path / str(i)))
        assert df.columns == columns
        rows = rows_of(df)
        assert {r["doc_id"]: (r["text"], r["lang"], r["source"]) for r in rows} == expected and len(rows) == len(expected)
        assert i == 0 or all(r["n_chars"] == len(r["text"]) for r in rows)
    encode = Tokenizer.from_file(tokenizer()).encode
    ids = {d: encode(x[0], add_special_tokens=False).ids + [1] for d, x in expected.items()}
    test_packing.check_pieces(rows_of(corpus_pipeline.run(spark, SF)), ids)


def test_awkward_documents(spark):
    for name, stage in corpus_pipeline.STAGES:
        docs = frame(spark, awkward())
        out = stage(spark, docs, "")
        assert name == "packing" or out.columns == docs.columns
        out.collect()
        assert stage(spark, frame(spark, []), "").count() == 0


def test_rows_without_an_id_or_with_the_same(spark):
    cases = [(None, f"n{i} " * (5 + i)) for i in range(12)] + [(3, f"t{i} " * (4 + i)) for i in range(12)]
    docs = frame(spark, cases)
    near = rows_of(corpus_pipeline.near_dedup(spark, docs, ""))
    assert sorted(r["text"] for r in near if r["doc_id"] is None) == sorted(t for d, t in cases if d is None)
    mixed = rows_of(corpus_pipeline.mix_sources(spark, docs, ""))
    rows = [(r["doc_id"], (test_mixing.domain(r["source"]), r["lang"], r["source"]), len(WORD.findall(r["text"])))
            for r in rows_of(docs)]
    taken = [(r[0], r[-2]) for r in test_mixing.plain(rows, WEIGHTS, ["domain", "lang", "source"], (4, 5), 1, 7) if r[-1]]
    assert multiset((r["doc_id"], len(WORD.findall(r["text"]))) for r in mixed) == multiset(taken)
    assert any(d is None for d, _ in taken) and len(taken) < len(cases)


def test_stage_names():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and all(callable(f) for _, f in corpus_pipeline.STAGES)
