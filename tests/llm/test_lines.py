import pytest
from cases import SF, WORD, awkward, documents, frame, rows_of
from compare import connect, difference
from hypothesis import given, settings, strategies as st
from loomwire.llm import line_dedup
from loomwire.llm.queries import ORACLES, op4_line_neighbours


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return any(a[p + i:] == b[p + j:] for i, j in ((0, 0), (1, 1), (1, 0), (0, 1)))


def plain(cases, least_words=8):
    """kept and near line numbers per id (None as NO_ID); rows with one id are one document here."""
    first = {}
    for d, t in sorted(cases, key=lambda c: line_dedup.NO_ID if c[0] is None else c[0]):
        for i, line in enumerate((t or "").split("\n") if t is not None else []):
            w = tuple(WORD.findall(line))
            if w:
                first.setdefault(w, (line_dedup.NO_ID if d is None else d, i))
    order = sorted(first, key=first.get)
    out = {}
    by_ends = {}
    for w in order:
        d, i = first[w]
        near = False
        if len(w) >= least_words:
            # any copy by one word shares the first or the last three words
            keys = (0, w[:3]), (1, w[-3:])
            near = any(within_one(w, x) for k in keys for x in by_ends.get(k, ()))
            for k in keys:
                by_ends.setdefault(k, []).append(w)
        out.setdefault(d, ([], []))[near].append(i)
    return {d: (sorted(a), sorted(b)) for d, (a, b) in out.items()}


def told(df):
    return {r["doc_id"]: (r["kept"], r["near"]) for r in rows_of(df)}


def test_all_documents(spark):
    rows = rows_of(op4_line_neighbours(spark, SF))
    found = {r["doc_id"]: tuple([int(x) for x in r[c].split(",") if x] for c in ("kept", "near")) for r in rows}
    assert found == plain(documents().items())
    assert all(r["n_kept"] == len(found[r["doc_id"]][0]) and r["n_near"] == len(found[r["doc_id"]][1]) for r in rows)


def test_same_rows_as_sql_on_a_larger_table(spark):
    sf = "/root/testdata/sf0.1"
    assert difference(op4_line_neighbours(spark, sf), connect(sf), ORACLES["op4_line_neighbours"]) is None


def test_no_python_on_the_path(spark):
    plan = op4_line_neighbours(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_awkward_documents(spark):
    cases = awkward()
    assert told(line_dedup.line_verdicts(frame(spark, cases))) == plain(cases)
    out = line_dedup.dedup_lines(frame(spark, cases))
    assert out.columns == frame(spark, cases).columns and out.count() == len(cases)
    texts = {r["doc_id"]: r["text"] for r in rows_of(out)}
    assert texts[3] is None and texts[4] == "" and texts[8] == "" and texts[13] == "same line of text here"
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


WORDS = st.lists(st.sampled_from("abc"), min_size=7, max_size=10).map(" ".join)


def test_same_neighbours_in_another_order(spark):
    """Lines with equal sums of neighbour hashes: the earliest of a key is no copy, a later one is."""
    a, b = "a b c a d a e f g", "a d a b c a e f g"
    cases = [(0, b + " x"), (1, a + " x"), (2, a + " y"), (3, b + " z"), (4, a)]
    assert told(line_dedup.line_verdicts(frame(spark, cases))) == plain(cases)


@settings(max_examples=8, deadline=None)
@given(st.lists(WORDS, min_size=2, max_size=40))
def test_small_alphabet(spark, texts):
    cases = list(enumerate(texts))
    assert told(line_dedup.line_verdicts(frame(spark, cases))) == plain(cases)


@pytest.mark.parametrize("n", [8, 9, 25, 26, 27, 28, 29, 40])
def test_one_word_anywhere(spark, n):
    line = [f"w{i}" for i in range(n)]
    cases = [(0, " ".join(line))]
    for i in range(n):
        cases += [(len(cases), " ".join(line[:i] + ["x"] + line[i + 1:])), (len(cases) + 1, " ".join(line[:i] + line[i + 1:])),
                  (len(cases) + 2, " ".join(line[:i] + [f"y{i}"] + line[i:]))]
    assert told(line_dedup.line_verdicts(frame(spark, cases))) == plain(cases)


@pytest.mark.parametrize("least_words", [3, 7, 8])
def test_isolated_pairs(spark, least_words):
    """One line and one copy of it, on their own, at each length where the ends change, either one first."""
    cases = []
    for n in range(6, 31):
        for at in (0, n // 2, n - 1):
            for first in (0, 1):
                line = [f"n{n}a{at}f{first}w{i}" for i in range(n)]
                pair = [line, line[:at] + line[at + 1:]]
                cases += [(len(cases), " ".join(pair[first])), (len(cases) + 1, " ".join(pair[1 - first]))]
                swapped = [x + "r" for x in line]
                cases += [(len(cases), " ".join(swapped)), (len(cases) + 1, " ".join(swapped[:at] + ["x"] + swapped[at + 1:]))]
    assert told(line_dedup.line_verdicts(frame(spark, cases), least_words)) == plain(cases, least_words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=6), st.lists(st.sampled_from("ab"), max_size=6))
def test_within_one_is_edit_distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a):
        d, old = [i + 1], d
        for j, y in enumerate(b):
            d.append(min(old[j + 1] + 1, d[j] + 1, old[j] + (x != y)))
    assert within_one(a, b) == (d[-1] <= 1)


def test_verification(spark):
    pairs = [(["a", "b"], ["a", "c"]), (["a", "b"], ["b", "a"]), (["a"], ["a", "b"]), (["x", "a"], ["a"]), (["a"], ["a"]),
             (["a", "b", "c"], ["a"])]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>").select("a", "b", line_dedup._within_one("a", "b").alias("ok"))
    for r in rows_of(df):
        assert r["ok"] == within_one(r["a"], r["b"]), r


def test_few_lines_move_to_a_join_that_keeps_few(spark, monkeypatch):
    rows = spark.range(100_000).selectExpr("id AS place", "cast(id AS string) AS content")
    wanted = spark.range(0, 100_000, 50).toDF("place")
    found = {r["place"] for r in line_dedup._among(rows, wanted).collect()}
    assert found >= set(range(0, 100_000, 50)) and len(found) < 20_000
    assert line_dedup._among(rows, wanted.limit(0)).count() == 0
    monkeypatch.setattr(line_dedup, "MAPS", 1)  # a full bitmap
    assert line_dedup._among(rows, spark.range(0, 100_000, 2).toDF("place")).where("place % 2 = 0").count() == 50_000
