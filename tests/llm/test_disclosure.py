import hashlib
import random
import re

import pytest
from cases import SF, awkward, documents, frame, rows_of
from hypothesis import given, settings, strategies as st
from loomwire.llm import disclosure
from loomwire.llm.queries import op8_disclosure

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p) < 500 and int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=2000, deadline=None)
@given(st.text(st.sampled_from("a@.+-1234 0(%é\n"), max_size=40))
def test_patterns(text):
    assert disclosure.base_spans(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4012-8888-8888-1881", "+1 (212) 555-0100", "10.0.0.256", "1.2.3.4", " ",
                                 "a.b@c.de", "x@y", ".", "-", "+49", "378282246310005"]), max_size=8).map("".join))
def test_planted_patterns(text):
    assert disclosure.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["9" * 200_000, "a" * 200_000, "a@" * 100_000, "1." * 100_000, "+1" + " " * 200_000,
                                  "a.b" * 100_000 + "@", "1 " * 100_000])
def test_long_texts_take_linear_time(text):
    disclosure.base_spans(text)


def test_all_documents(spark):
    texts = documents()
    rows = rows_of(op8_disclosure(spark, SF))
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]] or "")
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in disclosure.KINDS] == [sum(b[0] == k for b in base) for k in disclosure.KINDS]
        assert r["spans"].startswith(told)


def test_disclosing_terms(spark):
    rng = random.Random(3)
    filler = [f"{a}{b}{c}" for a in "bdfg" for b in ("olin", "aren", "usti") for c in ("mer", "ta", "so")]
    noise = lambda: " ".join(rng.choices(filler, k=25))
    cases = [(i, f"{noise()} write to ann.example@mail.org our Zebrafish expert {noise()}") for i in range(6)]
    cases += [(i, f"{noise()} write to us our expert {noise()}") for i in range(6, 40)]
    rows = {r["doc_id"]: r for r in rows_of(disclosure.find(frame(spark, cases)))}
    for i, text in cases:
        spans = [(text[s["start"]:s["end"]], s["action"]) for s in rows[i]["disclosing"]]
        assert spans == ([("Zebrafish", "remove")] if i < 6 else []), spans
    clean = disclosure.sanitised(cases[0][1], rows[0]["base"], rows[0]["disclosing"])
    assert "Zebrafish" not in clean and "[EMAIL]" in clean and "expert" in clean
    # without enough evidence nothing is taken
    few = rows_of(disclosure.find(frame(spark, cases[:2] + cases[6:])))
    assert not any(r["disclosing"] for r in few)


def test_scores_against_plain_counts(spark):
    cases = [(d, t) for d, t in documents().items()]
    reach, least, threshold = 80, 3, 0.8
    marked = [(i, disclosure.base_spans(t or ""), t or "") for i, (_, t) in enumerate(cases)]
    near = {(i, e, w, a, b) for i, spans, t in marked for e, w, a, b in disclosure.context(t, spans, reach)}
    import math
    pairs, entities, terms = {}, {}, {}
    for i, e, w, _, _ in near:
        pairs.setdefault((e, w), set()).add(i)
        entities.setdefault(e, set()).add(i)
    for i, _, t in marked:
        for w in set(re.findall(r"[^\W\d_]+", t.lower())):
            terms.setdefault(w, set()).add(i)
    n = len(cases)
    expected = set()
    for i, e, w, a, b in near:
        both, ne, nt = len(pairs[e, w]), len(entities[e]), len(terms[w])
        ic = math.log(n / ne)
        if both >= least and ic > 0 and math.log(n * both / (ne * nt)) >= threshold * ic:
            expected.add((cases[i][0], a, b))
    rows = rows_of(disclosure.find(frame(spark, cases), threshold, least, reach))
    assert {(r["doc_id"], s["start"], s["end"]) for r in rows for s in r["disclosing"]} == expected


def test_whole_texts_and_entities_of_few_documents(spark):
    rng = random.Random(5)
    filler = [f"{a}{b}{c}" for a in "bdfg" for b in ("olin", "aren", "usti") for c in ("mer", "ta", "so")]
    noise = lambda: " ".join(rng.choices(filler, k=30))
    cases = [(0, f"Zebrafish {noise()} mail ann@mail.org and bob@mail.org {noise()} zebrafish"),
             *[(i, f"{noise()} mail eve@mail.org {noise()} Okapi") for i in (1, 2)],
             *[(i, f"{noise()} mail and {noise()}") for i in range(3, 1200)]]
    rows = {r["doc_id"]: r for r in rows_of(disclosure.find(frame(spark, cases)))}
    told = {i: [(t[s["start"]:s["end"]], s["action"]) for s in rows[i]["disclosing"]] for i, t in cases}
    assert {i: x for i, x in told.items() if x} == {0: [("Zebrafish", "remove"), ("zebrafish", "remove")],
                                                   1: [("Okapi", "remove")], 2: [("Okapi", "remove")]}


def test_whole_texts_against_plain_counts(spark):
    import math
    cases = [(d, t or "") for d, t in documents().items()]
    said = {d: set(re.findall(r"[^\W\d_]+", t.lower())) for d, t in cases}
    spans = {d: disclosure.base_spans(t) for d, t in cases}
    holds, outside = {}, {}
    for d, t in cases:
        for kind, a, b in spans[d]:
            holds.setdefault(disclosure._entity(kind, t[a:b]), set()).add(d)
        outside[d] = [(m[0].lower(), *m.span()) for m in re.finditer(r"[^\W\d_]{3,}", t)
                      if not any(a < m.end() and m.start() < b for _, a, b in spans[d])]
    n, expected = len(cases), set()
    terms = {d: {w for w, _, _ in outside[d]} for d in spans}
    for docs in holds.values():
        ic = math.log(n / len(docs))
        for w in set().union(*(terms[d] for d in docs)):
            both, nt = sum(w in terms[d] for d in docs), sum(w in x for x in said.values())
            q, p = both / len(docs), nt / n
            evidence = len(docs) * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0))
            if math.log(n * both / (len(docs) * nt)) >= 0.8 * ic > 0 and evidence >= -math.log(0.02):
                expected |= {(d, a, b) for d in docs for x, a, b in outside[d] if x == w}
    rows = rows_of(disclosure.find(frame(spark, cases), chance=0.02))
    assert expected and {(r["doc_id"], s["start"], s["end"]) for r in rows for s in r["disclosing"]} == expected


def test_awkward_documents(spark):
    rows = rows_of(disclosure.find(frame(spark, awkward())))
    assert len(rows) == len(awkward()) and disclosure.find(frame(spark, [])).count() == 0
