"""Crawl order: pointer doubling against the recursive SQL and against a plain walk."""

import random

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from loomwire.operators import crawl
from loomwire.operators.crawl import crawl_positions


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_crawl_order_equals_recursive_sql(spark, sf):
    query = entry.queries()["crawl_order"](spark, sf)
    assert query.count() > 0
    assert difference(query, connect(sf), entry.oracle_sql()["crawl_order"]) is None


def walk(links, start):
    seen, page, out = set(), start, {}
    while page in links and page not in seen:
        out[page] = len(seen)
        seen.add(page)
        nxt = links[page]
        page = nxt if nxt in links and nxt != page else None
    return out


def test_random_functional_graphs(spark):
    rng = random.Random(4)
    for n in (1, 2, 7, 40):
        links = {f"p{i}": (f"p{rng.randrange(n + 3)}" if rng.random() < 0.9 else None) for i in range(n)}
        starts = [f"p{i}" for i in range(n) if rng.random() < 0.5] + ["missing"]
        df = spark.createDataFrame(list(links.items()) + [(None, "p0")], "page string, next string")
        got = {(r["start"], r["page"]): r["position"] for r in
               crawl_positions(df, spark.createDataFrame([(s,) for s in starts], "start string")).collect()}
        want = {(s, p): k for s in set(starts) if s in links for p, k in walk(links, s).items()}
        assert got == want


def test_cycles_are_listed_once(spark, monkeypatch):
    """Walks around a cycle went on until their steps passed the number of pages; each level wrote all rows again."""
    rows, write = [], crawl.written

    def counted(df):
        out = write(df)
        rows.append(out.count() if "step" in out.columns else 0)
        return out

    monkeypatch.setattr(crawl, "written", counted)
    links = {f"p{c}-{n}": f"p{c}-{n + 1 if n < 7 else 5}" for c in range(40) for n in range(8)}
    starts = [f"p{c}-{n}" for c in range(40) for n in (0, 6)]
    df = spark.createDataFrame(list(links.items()), "page string, next string")
    got = crawl_positions(df, spark.createDataFrame([(s,) for s in starts], "start string")).collect()
    want = {(s, p): k for s in starts for p, k in walk(links, s).items()}
    assert {(r["start"], r["page"]): r["position"] for r in got} == want and len(got) == len(want) == sum(rows)
