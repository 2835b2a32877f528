import math
from collections import Counter

import pytest
from cases import SF, WORD, ascii_lower, awkward, documents, frame, rows_of
from loomwire.llm import backoff
from loomwire.llm.queries import op7_backoff_scores


def grams(words, n):
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def plain(cases, order=3, discount=0.4):
    texts = [WORD.findall(ascii_lower(t or "")) for _, t in cases]
    corpus = [sum((grams(w, n) for w in texts), Counter()) for n in range(1, order + 1)]
    total = sum(map(len, texts))
    out = []
    for (d, _), words in zip(cases, texts):
        own = [grams(words, n) for n in range(1, order + 1)]
        count = lambda g: corpus[len(g) - 1][g] - own[len(g) - 1][g]
        score = 0.0
        for i in range(len(words)):
            for n in range(order, 0, -1):
                gram = tuple(words[i - n + 1:i + 1]) if i >= n - 1 else None
                if n == 1:
                    score += math.log(max(count(gram), 0.5) / max(total - len(words), 1))
                elif gram and count(gram) > 0 and count(gram[:-1]) > 0:
                    score += math.log(count(gram) / count(gram[:-1]))
                    break
                if n > 1:
                    score += math.log(discount)
        out.append((d, len(words), score / len(words) if words else None))
    return out


def same(rows, expected):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or 0)
    got = sorted(((r["doc_id"], r["n_words"], r["score"]) for r in rows), key=key)
    expected = sorted(expected, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    for a, b in zip(got, expected):
        assert a[2] == (None if b[2] is None else pytest.approx(b[2])), (a, b)


def test_all_documents(spark):
    same(rows_of(op7_backoff_scores(spark, SF)), plain(documents().items(), backoff.Model().order))


@pytest.mark.parametrize("model", [backoff.Model(), backoff.Model(order=2, block_rows=2, slice_grams=1000),
                                   backoff.Model(order=1), backoff.Model(order=4, slice_grams=20_000)])
def test_awkward_documents(spark, model):
    cases = awkward()
    same(rows_of(backoff.backoff_scores(frame(spark, cases), model)), plain(cases, model.order))
    assert backoff.backoff_scores(frame(spark, [])).count() == 0
