"""Spelling variants by composition against a plain version of the contract."""

import re
import zlib

import pytest

from loomwire.llm import spelling

from cases import ascii_lower, awkward, documents, frame

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def plain(rows, ratio=2):
    counts = {}
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1:]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    variants = {}
    for w in words:
        for i in range(len(w)):
            variants.setdefault(w[:i] + w[i + 1:], set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1:]
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
            for v in variants.get(cut, ()):
                if v != w and len(v) == len(w) and sum(a != b for a, b in zip(v, w)) == 1:
                    near[w].add(v)
    out = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = dict(word=w, form=form, n=n, n_near=len(near[w]), form_n=words[form] if form else None)
    for w, row in out.items():
        root = w
        while out[root]["form"] is not None:
            root = out[root]["form"]
        row["root"] = root
    return out


def compare(spark, rows, df):
    got = {r["word"]: r.asDict() for r in spelling.spelling_variants(df).collect()}
    want = plain(rows)
    assert got == want
    return got


def test_sf_documents(spark):
    docs = documents()
    rows = list(docs.items())
    got = compare(spark, rows, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert any(r["form"] for r in got.values())


def test_awkward_documents(spark):
    rows = awkward() + [(20, "colour colour colour color color color color color color color color"),
                        (21, "Straße strasse strase strasse aaaab aaab aaaab aaaab aaab aaab aaaaab aaaaab aaaaab"),
                        (22, "naïve naive naive naïve naïve naïve naïve naïve")]
    compare(spark, rows, frame(spark, rows))


def test_chain_and_empty(spark):
    rows = [(1, " ".join(["abcdef"] * 3 + ["abcdeg"] * 7 + ["abcdeh"] * 20 + ["xbcdeh"] * 60))]
    got = compare(spark, rows, frame(spark, rows))
    assert got["abcdef"]["root"] == "xbcdeh"
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_variants(empty).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_random_small_alphabet(spark, seed):
    import random

    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 7))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(30)]
    compare(spark, rows, frame(spark, rows))


def test_growing_tables_are_merged_in_tasks(spark, monkeypatch):
    """Spark takes split words for as small as the words: their broadcast filled the driver."""
    plans, write = [], spelling.written

    def noted(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return write(df)

    monkeypatch.setattr(spelling, "written", noted)
    rows = [(1, " ".join(["abcdef"] * 3 + ["abcdeg"] * 7 + ["abcdeh"] * 20 + ["xbcdeh"] * 60))]
    noted(spelling.spelling_variants(frame(spark, rows)))
    assert len(plans) > 6 and not [p for p in plans if "Broadcast" in p]
