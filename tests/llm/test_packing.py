import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from cases import SF, awkward, documents, frame, rows_of
from hypothesis import given, settings, strategies as st
from loomwire.llm import packing, token_files
from loomwire.llm.queries import op3_ordered_packing, op9_orc_tokens, tokenizer
from loomwire.llm.tokens import Encoder

ODD = ["", " \n", "it's  <|endoftext|>x́ ÀB's Ⅷ 12 ab1.   z İß ﬁ a...! don't. x<|startoftext|> \x85a\xa0b ́q",
       "don't won't 'tis 'twas!? ÀÉ.", "a\x1cb\x1dc d", "<|ENDOFTEXT|>", "word,word;word", "x" * 5000]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer())
    return lambda texts, end: [e.ids + [end] for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def own():
    return Encoder(tokenizer(), 2)


def same_ids(own, reference, texts):
    ids, bounds, _ = own.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == reference(texts, 2)


def test_ids_are_the_tokenizers(own, reference):
    same_ids(own, reference, ODD + list(documents().values()))


def test_words_of_known_pieces_need_no_tokenizer(reference, monkeypatch):
    own, asked = Encoder(tokenizer(), 2), []
    inner = own._encode
    monkeypatch.setattr(own, "_encode", lambda texts: asked.extend(texts) or inner(texts))
    same_ids(own, reference, ["Wörter the, word###"])
    before = len(asked)
    same_ids(own, reference, ["WÖRTER### THE### Word, wörter the### Word###"])
    own._clear_words()
    same_ids(own, reference, ["the word, the WORD###"])
    assert len(asked) == before


@pytest.mark.parametrize("most", [0, 3, 40])
def test_ids_with_a_small_memory(reference, monkeypatch, most):
    monkeypatch.setattr("loomwire.llm.tokens._MEMORY", most)
    own, texts = Encoder(tokenizer(), 2), ODD + list(documents().values())[:40]
    for at in range(0, len(texts), 7):
        same_ids(own, reference, texts[at:at + 7])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_ids_of_any_text(own, reference, texts):
    same_ids(own, reference, [t.encode("utf-8", "ignore").decode() for t in texts])


def check_pieces(rows, ids, length=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids[d])
            piece = np.array(ids[d][at:at + p["length"]], "<u4")
            assert p["ids_crc32"] == zlib.crc32(piece.tobytes())
            at += p["length"]
        assert at == len(ids[d])
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= length
    used = sum(map(len, ids.values()))
    return 1 - used / (len(by_sequence) * length)


def test_all_documents(spark, reference):
    texts = documents()
    ids = dict(zip(texts, reference(list(texts.values()), 1)))
    rows = rows_of(op3_ordered_packing(spark, SF))
    assert check_pieces(rows, ids) < 0.04  # a window per task may be part empty in so small a table
    order = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    assert [r["doc_id"] for r in order] == sorted(r["doc_id"] for r in rows)


def test_awkward_documents(spark, reference):
    cases = [(d, t) for d, t in dict(awkward()).items() if d]
    ids = {d: reference([t or ""], 1)[0] for d, t in cases}
    costs = packing.Costs(length=64, block_tokens=500)
    check_pieces(rows_of(packing.pack(frame(spark, cases), tokenizer(), costs=costs)), ids, 64)
    assert packing.pack(frame(spark, awkward()), tokenizer()).count() >= len(awkward())
    assert packing.pack(frame(spark, []), tokenizer()).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 8), st.lists(st.tuples(st.integers(1, 6), st.integers(0, 9)), min_size=1, max_size=12))
def test_cuts_cost_least(length, steps):
    length = max(length, max(s for s, _ in steps))
    places = np.cumsum([0] + [s for s, _ in steps])
    penalty = np.array([0.0] + [float(p) for _, p in steps])
    cost = [0.0]
    for j in range(1, len(places)):
        cost.append(min(cost[i] + length - (places[j] - places[i]) + penalty[j] for i in range(j)
                        if places[j] - places[i] <= length))
    cuts = packing.best_cuts(places, penalty, length)
    assert cuts[0] == 0 and cuts[-1] == places[-1] and (np.diff(cuts) <= length).all()
    at = np.searchsorted(places, cuts)
    assert sum(penalty[at]) + length * (len(cuts) - 1) - places[-1] == pytest.approx(cost[-1])


def test_token_files(spark, reference, tmp_path):
    texts = documents()
    ids = reference([texts[d] for d in sorted(texts)], 2)
    rows = {r["doc_id"]: r for r in rows_of(op9_orc_tokens(spark, SF))}
    start = 0
    for d, expected in zip(sorted(texts), ids):
        assert rows[d] == {"doc_id": d, "start": start, "n_tokens": len(expected),
                           "ids_crc32": zlib.crc32(np.array(expected, "<u4").tobytes())}
        start += len(expected)
    cases = awkward()
    token_files.write_token_files(frame(spark, cases), str(tmp_path / "t"), tokenizer())
    back = token_files.read_token_files(spark, str(tmp_path / "t")).collect()
    assert len(back) == len(cases)
    end = 0
    for r in sorted(back, key=lambda r: r["start"]):
        assert r["start"] == end and r["n_tokens"] == len(r["ids"])
        end += r["n_tokens"]
    assert len(token_files.lookup(spark, str(tmp_path / "t"), [8]).collect()) == 2
    plan = token_files.lookup(spark, str(tmp_path / "t"), [8])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,8)]" in plan
    token_files.write_token_files(frame(spark, []), str(tmp_path / "e"), tokenizer())
    assert token_files.checked_token_files(spark, str(tmp_path / "e")).count() == 0
    assert list(Path(tmp_path / "t").glob("*.orc"))
