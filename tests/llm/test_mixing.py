import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest
from cases import SF, WORD, awkward, frame, multiset, rows_of
import pyarrow.parquet as pq
from hypothesis import given, settings, strategies as st
from loomwire.llm import mixing
from loomwire.llm.queries import WEIGHTS, mix_levels, op6_tree_mix


def split(budget, children):
    """children: name -> (weight, capacity). Rounds of shares; a full child leaves, its shortage goes to the others."""
    given, open_ = {}, dict(children)
    left = budget
    while open_:
        weights = sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if Fraction(c, w) <= Fraction(left, weights)]
        if not full:
            return given | {n: min(c, left * w // weights) for n, (w, c) in open_.items()}
        # the least capacity per weight leaves first
        n = min(full, key=lambda n: Fraction(open_[n][1], open_[n][0]))
        given[n] = open_[n][1]
        left -= given[n]
        del open_[n]
    return given


def budgets(leaves, weights, levels, budget):
    """leaves: path -> capacity."""
    budget = min(budget, sum(leaves.values()))
    if not levels:
        return {(): budget}
    groups = defaultdict(dict)
    for path, c in leaves.items():
        groups[path[0]][path[1:]] = c
    shares = split(budget, {n: (weights.get(levels[0], {}).get(n, 1), sum(g.values())) for n, g in groups.items()})
    return {(n, *rest): b for n, g in groups.items() for rest, b in budgets(g, weights, levels[1:], shares[n]).items()}


def plain(rows, weights, levels, share, epochs, seed):
    """rows: (doc_id, path, tokens)."""
    leaves = defaultdict(int)
    for _, path, n in rows:
        leaves[path] += n
    found = budgets({p: n * epochs for p, n in leaves.items()}, weights, levels, sum(leaves.values()) * share[0] // share[1])
    out = []
    for path in leaves:
        whole, room = divmod(found[path], leaves[path]) if leaves[path] else (0, 0)

        def order(r):
            return hashlib.md5(f"{seed}:{whole}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), \
                (r[0] is not None, r[0] or 0), r[2]
        before = 0
        for d, _, n in sorted((r for r in rows if r[1] == path), key=order):
            out.append((d, *path, n, whole + (before + n <= room)))
            before += n
    return out


def domain(source):
    return f"domain{int(source[3:]) % 4}" if source else None


def told(df):
    return multiset(tuple(r) for r in df.collect())


def test_all_documents(spark):
    table = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    rows = [(r["doc_id"], (domain(r["source"]), r["lang"], r["source"]), len(WORD.findall(r["text"] or ""))) for r in table]
    expected = plain(rows, WEIGHTS, ["domain", "lang", "source"], (4, 5), 2, 7)
    assert told(op6_tree_mix(spark, SF)) == multiset(expected)


@pytest.mark.parametrize("share,epochs", [((1, 2), 1), ((3, 1), 4), ((0, 1), 1), ((1, 1), 1)])
def test_awkward_documents(spark, share, epochs):
    cases = awkward()
    df = frame(spark, cases)
    rows = [(r["doc_id"], (domain(r["source"]), r["lang"], r["source"]), len(WORD.findall(r["text"] or "")))
            for r in rows_of(df)]
    expected = plain(rows, WEIGHTS, ["domain", "lang", "source"], share, epochs, 1)
    assert told(mixing.mix(df, mix_levels(), WEIGHTS, share, epochs, 1)) == multiset(expected)
    assert mixing.mix(frame(spark, []), mix_levels(), WEIGHTS).count() == 0


NAMES = st.sampled_from("abcd")


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(st.tuples(NAMES, NAMES), st.integers(0, 60), min_size=1, max_size=12), st.integers(0, 100))
def test_budgets_of_trees(spark, leaves, percent):
    weights = {"x": {"a": 5, "b": 2}, "y": {"c": 7}}
    df = spark.createDataFrame([(*p, n) for p, n in leaves.items()], "x string, y string, tokens long")
    got = {(r["x"], r["y"]): r["budget"] for r in
           mixing.leaf_budgets(df, ["x", "y"], weights, (percent, 50), 1).collect()}
    assert got == budgets(leaves, weights, ["x", "y"], sum(leaves.values()) * percent // 50)
