import zstandard
from collections import Counter

import pytest
from cases import WORD, awkward, documents, frame, rows_of
from loomwire.llm import compression
from loomwire.llm.queries import op1_compression_bands
from cases import SF


def plain(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(inside),
            "base_failed": len(words) < 20 or 100 * len(inside) > 30 * len(words)}


def verdict(text, limits=compression.Limits()):
    raw, c = text.encode(), zstandard.ZstdCompressor(level=limits.level)
    low, high = next((a, b) for n, a, b in limits.bands if n is None or len(raw) < n)
    chunks = [raw[i:i + 4096] for i in range(0, len(raw), 4096)]
    ratios = [len(x) / len(c.compress(x)) for x in chunks if len(x) >= 2048]
    bad = sum(not 1.3 <= r <= 3.6 for r in ratios)
    return low <= len(raw) / len(c.compress(raw)) <= high and bad <= 0.34 * len(ratios)


def check(row, text):
    expected = plain(text)
    assert {k: row[k] for k in expected} == expected
    assert row["kept"] == (not expected["base_failed"] and verdict(text))


def test_all_documents(spark):
    texts = documents()
    rows = rows_of(op1_compression_bands(spark, SF))
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for row in rows:
        check(row, texts[row["doc_id"]])


def test_awkward_documents(spark):
    cases = awkward()
    rows = rows_of(compression.quality(frame(spark, cases)))
    texts = dict((d, t) for d, t in cases if d)
    assert len(rows) == len(cases)
    for row in rows:
        if row["doc_id"]:
            check(row, texts[row["doc_id"]] or "")
    kept = compression.keep_good(frame(spark, cases))
    assert kept.columns == frame(spark, cases).columns
    assert kept.count() == sum(r["kept"] for r in rows)
    assert compression.quality(frame(spark, [])).count() == 0


@pytest.mark.parametrize("text,good", [("ab " * 400, False), ("x" * 5000 + " " + " ".join(map(str, range(30))), False)])
def test_repetitive_text_goes(spark, text, good):
    assert rows_of(compression.quality(frame(spark, [(1, text)])))[0]["kept"] is good


def test_random_text_goes(spark):
    import base64
    import random
    noise = base64.b85encode(random.Random(1).randbytes(40_000)).decode()
    text = " ".join(noise[i:i + 9] for i in range(0, len(noise), 9))
    assert not rows_of(compression.quality(frame(spark, [(1, text)])))[0]["kept"]
