import itertools
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from loomwire.functions.text import tokens_unicode
from loomwire.operators.components import connected_components
from loomwire.operators.ordering import with_index
from loomwire.operators.topic_terms import topic_names
from loomwire.operators.vectors import encode_with, hashed_embedding, join_vectors
from loomwire.plans.topics import TopicModel, assign_points, clustered_articles, fit_topics, numbered_points, topic_info
from loomwire.plans.trend import trend_scores
from loomwire.session import scratch, written

SLOW = dict(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_with_index(spark):
    df = spark.range(1000).selectExpr("1000 - id AS v").repartition(7)
    got = with_index(df, ["v"]).collect()
    assert sorted((r["v"], r["index"]) for r in got) == [(i + 1, i) for i in range(1000)]


def test_scratch_tables_go_at_the_end(spark):
    from pathlib import Path
    with scratch(spark) as folder:
        first = written(spark.range(5))
        assert first.count() == 5 and len(list(Path(folder.removeprefix("file:")).iterdir())) == 1
    assert not Path(folder.removeprefix("file:")).exists()
    assert written(spark.range(3)).count() == 3


@settings(**SLOW)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=25))
def test_components(spark, edges):
    nodes = range(31)
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = connected_components(spark.range(31).withColumnRenamed("id", "node"),
                               spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in got} == root


def test_components_of_a_long_path(spark):
    n = 3000
    path = spark.range(n - 1).selectExpr("id AS u", "id + 1 AS v")
    got = connected_components(spark.range(n).withColumnRenamed("id", "node"), path)
    assert got.where("component <> 0").count() == 0


def brute_force(points, dims, eps, min_pts, min_size, fineness=4):
    """DBSCAN on the lattice by all pairs, numbered as the library does."""
    side = eps / (fineness * dims ** 0.5)
    snapped = [tuple(math.floor(x / side) for x in p) for p in points]
    limit = dims * fineness ** 2
    weight = Counter(snapped)
    dist = {(a, b): sum((x - y) ** 2 for x, y in zip(a, b)) for a in weight for b in weight}
    core = sorted(a for a in weight if sum(w for b, w in weight.items() if dist[a, b] <= limit) >= min_pts)
    comp = {a: a for a in core}
    for _ in core:
        for a, b in itertools.product(core, core):
            if dist[a, b] <= limit:
                comp[a] = comp[b] = min(comp[a], comp[b])
    cell = {a: tuple(x // fineness for x in a) for a in weight}
    # a component's number follows its least cell, whose number is its least point, core or not
    first = {c: min(a for a in weight if cell[a] == c) for c in set(cell.values())}
    label = {r: min(first[cell[a]] for a in core if comp[a] == r) for r in set(comp.values())}
    found = {a: label[comp[a]] for a in core}
    for a in weight:
        near = [(dist[a, b], found[b]) for b in core if dist[a, b] <= limit]
        if a not in core and near:
            found[a] = min(near)[1]
    size = Counter()
    for s in snapped:
        if s in found:
            size[found[s]] += 1
    order = sorted((-n, min(i for i, s in enumerate(snapped) if found.get(s) == c), c) for c, n in size.items() if n >= min_size)
    number = {c: i for i, (_, _, c) in enumerate(order)}
    return [number.get(found.get(s), -1) for s in snapped]


@pytest.mark.parametrize("dims, seed", [(1, 1), (2, 2), (5, 3)])
def test_density_equals_brute_force(spark, dims, seed):
    rng = np.random.default_rng(seed)
    reach = 20 if dims == 1 else 1
    centres = rng.uniform(-reach, reach, (6, dims))
    points = np.concatenate([c + rng.normal(0, 0.06, (25, dims)) for c in centres] + [rng.uniform(-reach, reach, (40, dims))])
    points = np.concatenate([points, np.repeat(points[:1], 95, axis=0)])  # a third of all rows are copies
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, coords array<double>")
    found = numbered_points(rows, "id", "coords", dims, 0.15)
    got = [r["topic"] for r in assign_points(rows, "coords", found, dims, 0.15, 4).orderBy("id").collect()]
    assert got == brute_force(points.tolist(), dims, 0.15, 5, 5)
    assert len(set(got)) > 2


def test_planted_clusters_save_and_load(spark, tmp_path):
    rng = np.random.default_rng(0)
    centres = np.eye(32)[:4]
    planted = np.concatenate([c + rng.normal(0, 0.02, (25 + 5 * i, 32)) for i, c in enumerate(centres)] + [rng.normal(0, 1, (15, 32))])
    planted /= np.linalg.norm(planted, axis=1, keepdims=True)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(planted)], "id long, embedding array<float>")
    model = fit_topics(vectors, "id", eps=0.15)
    labels = {r["id"]: r["topic"] for r in model.assign(vectors).collect()}
    sizes = Counter(labels[i] for i in range(130))
    assert [sizes[t] for t in range(4)] == [40, 35, 30, 25]  # largest first
    assert sum(labels[i] == -1 for i in range(130, 145)) >= 12
    model.save(str(tmp_path / "model"))
    again = TopicModel.load(spark, str(tmp_path / "model")).assign(vectors)
    assert {r["id"]: r["topic"] for r in again.collect()} == labels


def test_articles_to_trend_scores(spark):
    themes = (["silk", "dress", "gown", "lace"], ["boot", "heel", "sole", "strap"])
    rows = [(i, " ".join(themes[i % 2]), " ".join(themes[i % 2][j % 4] for j in range(i % 3 + 8)), f"http://h{i % 3}/{i}",
             f"2024-01-{1 + i % 20:02d}T00:00:00+00:00") for i in range(40)]
    df = spark.createDataFrame(rows, "n long, title string, summary string, link string, ingested_at string")
    out, model = clustered_articles(df, "n", width=64, components=2, eps=0.3)
    assert set(out.columns) == {"n", "title", "summary", "link", "ingested_at", "text_clean", "topic"}
    topics = {r["n"]: r["topic"] for r in out.collect()}
    assert len(topics) == 40 and len(set(topics.values())) == 2 and all(topics[i] == topics[i % 2] for i in topics)
    scores = {r["topic"]: r for r in trend_scores(out, ("ingested_at", "n")).collect()}
    assert set(scores) == {str(t) for t in topics.values()}


def test_hashed_embedding(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, "b a a")], "id int, t string")
    got = {r["id"]: np.array(r["v"]) for r in df.select("id", hashed_embedding(tokens_unicode("t"), 16).alias("v")).collect()}
    assert got[2].tolist() == [0.0] * 16 and np.allclose(got[1], got[3]) and abs(np.linalg.norm(got[1]) - 1) < 1e-6


def test_user_encoder_in_batches(spark):
    def load():
        def encode(texts):
            assert len(texts) <= 4
            return np.array([[len(t), 1.0] for t in texts])
        return encode

    docs = spark.createDataFrame([(i, "x" * i if i else None) for i in range(20)], "id long, t string")
    vectors = encode_with(docs, "id", "t", load, batch_size=4)
    assert {r["id"]: r["embedding"] for r in join_vectors(docs, vectors, "id").collect()} == {i: [i, 1.0] for i in range(20)}


def test_topic_info(spark):
    docs = spark.createDataFrame([(1, 0, ["silk", "dress"], "one"), (2, 0, ["silk", "silk"], "two"), (3, -1, ["new"], "three"),
                                  (4, 0, [], "four")], "id int, topic int, tokens array<string>, text string")
    info = {r["Topic"]: r for r in topic_info(docs, "id", "topic", "tokens", "text").collect()}
    assert (info[0]["Count"], info[0]["Name"], info[0]["Representation"]) == (3, "0_silk_dress", ["silk", "dress"])
    assert info[0]["Representative_Docs"] == ["one", "two", "four"] and info[-1]["Name"] == "-1_new"


def test_topic_name_takes_four_terms(spark):
    lists = spark.createDataFrame([(0, list("abcdef"))], "topic int, terms array<string>")
    assert topic_names(lists).first()["name"] == "0_a_b_c_d"


def test_written_tables_are_stable(spark):
    df = written(spark.range(100).withColumn("r", F.rand()))
    assert df.collect() == df.collect() and df.schema["id"].dataType.simpleString() == "bigint"


def test_no_table_of_points_is_broadcast(spark):
    """Points, cells and components grow with the input; Spark would send such small tables through the driver."""
    from loomwire.operators.density import neighbour_cells

    def plan(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    cells = spark.createDataFrame([(i, i % 5, i // 5, 0) for i in range(25)], "node long, c0 long, c1 long, c2 long")
    pairs = neighbour_cells(cells, 3, 4)
    assert "Broadcast" not in plan(pairs) and pairs.count() > 25
    rows = spark.createDataFrame([(i, [0.01 * (i % 9), 0.01 * (i // 9)]) for i in range(90)], "id long, coords array<double>")
    points = written(numbered_points(rows, "id", "coords", 2, 0.06))
    moved = rows.withColumn("coords", F.transform("coords", lambda x: x + 0.008))
    assert "Broadcast" not in plan(assign_points(moved, "coords", points, 2, 0.06, 4).select("id", "topic"))
