"""NN-descent neighbours against exact kNN, HDBSCAN against an exact brute-force HDBSCAN on planted clusters."""

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loomwire.operators.hierarchy import hdbscan
from loomwire.operators.neighbours import _local_join, _projections, knn_graph


def exact_knn(ids, x, k, metric):
    if metric == "cosine":
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        d = 1 - x @ x.T
    else:
        d = np.linalg.norm(x[:, None] - x[None], axis=2)
    np.fill_diagonal(d, np.inf)
    return {ids[i]: set(ids[np.lexsort((ids, d[i]))[:k]]) for i in range(len(ids))}


def recall(graph, exact, k):
    got = {}
    for r in graph:
        got.setdefault(r["u"], set()).add(r["v"])
    return np.mean([len(got.get(u, set()) & want) / k for u, want in exact.items()])


def test_neighbour_graph_recall(spark):
    path = "/root/testdata/sf0.01/embeddings.parquet"
    table = pq.read_table(path).to_pydict()
    ids, x = np.array(table["vec_id"]), np.array(table["embedding"], dtype=float)
    graph = knn_graph(spark.read.parquet(path), "vec_id", "embedding", k=15).collect()
    assert {r["u"] for r in graph} == set(ids.tolist())
    assert all(sum(1 for r in graph if r["u"] == u) == 15 for u in ids[:20])
    assert recall(graph, exact_knn(ids, x, 15, "cosine"), 15) >= 0.9


def test_neighbour_graph_awkward(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, 1.1]), (3, None), (None, [1.0, 1.0]), (4, [float("nan"), 1.0]),
            (5, [3.0, 3.0]), (5, [3.0, 3.0]), (6, [1.0]), (7, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumn("u", F.lit("clash"))
    graph = knn_graph(df, "id", "v", k=2, metric="euclidean").collect()
    assert {r["u"] for r in graph} == {1, 2, 5, 7}
    assert {(r["u"], r["v"]) for r in graph if r["rank"] == 1} == {(1, 2), (2, 1), (5, 7), (7, 5)}
    assert knn_graph(spark.createDataFrame([], "id long, v array<double>"), "id", "v").collect() == []


def exact_hdbscan(x, mcs=5, samples=5):
    """Prim's tree of mutual reachability, single linkage, condensed tree, excess of mass; -1 noise."""
    n = len(x)
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    core = np.sort(d, axis=1)[:, samples - 1]
    mr = np.maximum(d, np.maximum(core[:, None], core[None]))
    seen, best, parent = np.zeros(n, bool), np.full(n, np.inf), np.full(n, -1)
    best[0], edges = 0, []
    for _ in range(n):
        u = int(np.argmin(np.where(seen, np.inf, best)))
        seen[u] = True
        if parent[u] >= 0:
            edges.append((best[u], parent[u], u))
        closer = ~seen & (mr[u] < best)
        best[closer], parent[closer] = mr[u][closer], u
    find = list(range(2 * n))
    members = {i: [i] for i in range(n)}

    def root(a):
        while find[a] != a:
            find[a] = find[find[a]]
            a = find[a]
        return a

    merges, nxt = {}, n
    for w, a, b in sorted(edges):
        ra, rb = root(a), root(b)
        merges[nxt] = (ra, rb, w)
        members[nxt] = members[ra] + members[rb]
        find[ra] = find[rb] = nxt
        nxt += 1
    top = nxt - 1
    clusters, children, stability, label_of = {0: None}, {0: []}, {0: 0.0}, {}
    birth = {0: 0.0}
    work = [(top, 0)]
    while work:
        node, c = work.pop()
        if node < n:
            continue
        a, b, w = merges[node]
        lam = 1 / w if w > 0 else np.inf
        big = [ch for ch in (a, b) if len(members[ch]) >= mcs]
        if len(big) == 2:
            for ch in big:
                new = len(clusters)
                clusters[new], children[new], stability[new], birth[new] = c, [], 0.0, lam
                children[c].append(new)
                stability[c] += len(members[ch]) * (lam - birth[c])
                work.append((ch, new))
        else:
            for ch in (a, b):
                if ch in big:
                    work.append((ch, c))
                else:
                    for p in members[ch]:
                        stability[c] += lam - birth[c]
                        label_of[p] = c
    chosen = {}
    total = {}
    for c in sorted(clusters, reverse=True):
        below = sum(total[k] for k in children[c])
        if c == 0:
            continue
        if not children[c] or stability[c] >= below:
            chosen[c], total[c] = True, stability[c]
        else:
            chosen[c], total[c] = False, below
    final = set()
    for c in sorted(clusters):
        if c and chosen[c]:
            up, blocked = clusters[c], False
            while up:
                blocked |= up in final
                up = clusters[up]
            if not blocked:
                final.add(c)
    labels = []
    for p in range(n):
        c = label_of.get(p, 0)
        while c and c not in final:
            c = clusters[c]
        labels.append(c if c else -1)
    return labels


def partition(labels):
    groups = {}
    for i, c in enumerate(labels):
        if c != -1:
            groups.setdefault(c, set()).add(i)
    return sorted(map(sorted, groups.values()))


def test_hdbscan_matches_exact_on_planted_clusters(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.1, (60, 3)), rng.normal(3, 0.4, (80, 3)), rng.normal([0, 4, 0], 0.8, (100, 3)),
                        rng.uniform(-3, 7, (20, 3))])
    df = spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(x)], "id long, v array<double>")
    got = {r["id"]: r["cluster"] for r in hdbscan(df, "id", "v").collect()}
    ours = [got[i] for i in range(len(x))]
    want = exact_hdbscan(x)
    assert len(set(ours) - {-1}) == len(set(want) - {-1}) == 3
    both = [i for i in range(len(x)) if ours[i] != -1 and want[i] != -1]
    assert partition([ours[i] for i in both]) == partition([want[i] for i in both])
    assert sum((a == -1) != (b == -1) for a, b in zip(ours, want)) <= 0.05 * len(x)
    sizes = {}
    for c in ours:
        sizes[c] = sizes.get(c, 0) + 1
    assert sizes[0] >= sizes[1] >= sizes[2]


def test_hdbscan_few_points(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, None)], "id long, v array<double>")
    assert sorted((r["id"], r["cluster"]) for r in hdbscan(df, "id", "v").collect()) == [(1, -1), (2, -1)]


def test_local_join_sends_only_pairs_that_may_be_chosen():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 4))
    rows = pd.DataFrame({"w": 1, "x": np.arange(40) * 7, "vx": list(x)})
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1)
    found = pd.concat(_local_join(iter([rows]), "euclidean", 5))
    assert set(zip(found["u"], found["v"])) == {(7 * i, 7 * j) for i in range(40) for j in order[i, :5]}
    # a node that has a k-th neighbour already gets nothing beyond it; one without a bound gets its k nearest
    bound = np.sort(d, axis=1)[:, 1]
    bound[0] = np.nan
    near = pd.concat(_local_join(iter([rows.assign(bound=bound)]), "euclidean", 5))
    want = {(7 * i, 7 * j) for i in range(40) for j in order[i, :5 if i == 0 else 2]}
    assert set(zip(near["u"], near["v"])) == want


def test_projections_are_sums_in_order():
    rng = np.random.default_rng(4)
    x, directions = rng.normal(size=(6, 9)), rng.normal(size=(3, 9))
    [got] = _projections(iter([pd.DataFrame({"id": range(6), "v": list(x)})]), directions)
    for row, p in zip(x, got["p"]):
        for direction, value in zip(directions, p):
            total = 0.0
            for a, b in zip(row.tolist(), direction.tolist()):
                total += a * b
            assert value == total
