import numpy as np
import pyarrow as pa
import pytest
from cases import SF, WORD, ascii_lower, awkward, documents, frame, rows_of
from hypothesis import given, settings, strategies as st
from loomwire.llm import superminhash as sm
from loomwire.llm.queries import op10_superminhash
from loomwire.llm.words import split_words


def sets_of(cases, n=5):
    out = []
    for _, t in cases:
        w = WORD.findall(ascii_lower(t or ""))
        out.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def plain(cases):
    sets = sets_of(cases)
    parent = list(range(len(cases)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        if cases[i][0] is None:
            continue
        for j in {j for g in s for j in where[g] if j < i and cases[j][0] is not None}:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    same = {}
    for i, (d, _) in enumerate(cases):  # rows with one id are one node
        if d is not None and sets[i]:
            j = same.setdefault(d, i)
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(cases):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    out = []
    for i, (d, _) in enumerate(cases):
        c = None if d is None else d if not sets[i] else least[root(i)]
        out.append((d, len(sets[i]), c, d is None or d == c))
    return sorted(out, key=repr)


def told(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows_of(df)), key=repr)


def test_all_documents(spark):
    assert told(op10_superminhash(spark, SF)) == plain(list(documents().items()))


def test_awkward_documents(spark):
    cases = awkward()
    assert told(sm.near_duplicates(frame(spark, cases))) == plain(cases)
    assert sm.near_duplicates(frame(spark, [])).count() == 0


def test_chains_and_hot_buckets(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    cases = []
    for g in range(3):  # chains: each text changes a little of the one before
        text = list(rng.choice(words, 120))
        for _ in range(30):
            text = list(text)
            text[rng.integers(120)] = "c" + str(rng.integers(10**6))
            cases.append((len(cases), " ".join(text)))
    shared = list(rng.choice(words, 100))
    for _ in range(120):  # one passage in many different texts
        cases.append((len(cases), " ".join(list(shared) + [f"v{rng.integers(10**6)}" for _ in range(rng.integers(10, 150))])))
    cases += [(len(cases) + i, cases[7][1].upper()) for i in range(200)]
    assert told(sm.near_duplicates(frame(spark, cases))) == plain(cases)


def one_by_one(elements, m):
    """The algorithm as published: elements one after another, each with its own permutation."""
    h = [m << 32] * m
    for e in elements:
        p = list(range(m))
        for j in range(m):
            draw = int(sm.mixed(np.array([e], np.uint64) + sm.step_salt(j))[0])
            low, high = draw & 0xFFFFFFFF, draw >> 32
            k = j + (low * (m - j) >> 32)
            p[j], p[k] = p[k], p[j]
            h[p[j]] = min(h[p[j]], (j << 32) | high)
    return h


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=30, unique=True), min_size=1, max_size=5),
       st.sampled_from([1, 3, 16]), st.sampled_from([2, 7, 1000]))
def test_signature_is_the_published_one(sets, m, chunk):
    flat = np.array([e for s in sets for e in s], np.uint64)
    bounds = np.cumsum([0] + [len(s) for s in sets])
    got = sm.signatures(flat, bounds, m, chunk)
    assert got.tolist() == [one_by_one(s, m) for s in sets]


def test_estimates_similarity():
    rng = np.random.default_rng(1)
    for percent in (75, 90):
        found = []
        for _ in range(30):
            both = rng.integers(0, 2**63, percent * 4, dtype=np.uint64)
            rest = rng.integers(0, 2**63, (100 - percent) * 4, dtype=np.uint64)
            half = len(rest) // 2
            a, b = np.concatenate((both, rest[:half])), np.concatenate((both, rest[half:]))
            s = sm.signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), 256)
            found.append((s[0] == s[1]).mean())
        assert np.mean(found) == pytest.approx(percent / 100, abs=0.02)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5000), max_size=2500, unique=True), min_size=1, max_size=4))
def test_parities_differ_in_no_more_bins_than_sets_in_elements(sets):
    flat = sm.mixed(np.array([e for s in sets for e in s], np.uint64))
    bits = sm.parities(flat, np.cumsum([0] + [len(s) for s in sets]), 2048)
    for s, x in zip(sets, bits):
        for t, y in zip(sets, bits):
            apart, differing = len(set(s) ^ set(t)), int((x != y).sum())
            assert differing <= apart and (apart - differing) % 2 == 0


def test_pairs_a_little_below_the_similarity_make_no_rows(spark, monkeypatch):
    """A template with slots: most pairs of texts are at 65 to 74 percent."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(160)]
    cases = []
    for i in range(300):
        text = list(words)
        for at in rng.choice(160, 4, replace=False):
            text[at] = f"c{rng.integers(10**6)}"
        cases.append((i, " ".join(text)))
    pairs, inner = [], sm._agreeing

    def counted(some, *rest):
        pairs.append(some.count())
        return inner(some, *rest)

    monkeypatch.setattr(sm, "_agreeing", counted)
    assert told(sm.near_duplicates(frame(spark, cases))) == plain(cases)
    assert pairs[-1] < 3000  # of 44,850


@pytest.mark.parametrize("n", [700, 1000, 1400])
def test_sizes_around_the_limit_of_parities(spark, n):
    cases, words = [], [f"w{i}" for i in range(n)]
    for i in range(60):
        text = list(words[:n - (i % 7) * n // 40])
        for at in range(i, len(text), 23 + i % 5):
            text[at] = f"c{i}_{at}"
        cases.append((i, " ".join(text)))
    assert told(sm.near_duplicates(frame(spark, cases))) == plain(cases)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \t\n\x0b\x0c\r\x1c\x85\xa0é"), max_size=12), min_size=1, max_size=4))
def test_words(texts):
    flat, bounds = split_words(pa.array(texts))
    words = flat.to_pylist()
    assert [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])] == [WORD.findall(t) for t in texts]
