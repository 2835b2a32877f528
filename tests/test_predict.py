"""Topics of points the fit did not see: the nearest core point within eps."""

import numpy as np

from loomwire.operators.density import density_clusters
from loomwire.plans.topics import assign_points, numbered_points

EPS, DIMS = 0.15, 3


def brute_nearest_core(x, fitted_x, core, topic, eps):
    d = np.linalg.norm(fitted_x[None] - x[:, None], axis=2)
    out = []
    for row in d:
        ok = np.flatnonzero(core & (topic != -1) & (row <= eps))
        out.append(int(topic[ok[np.lexsort((topic[ok], row[ok]))[0]]]) if len(ok) else -1)
    return out


def test_perturbed_training_points_keep_their_topics(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 0.05, (80, DIMS)), rng.normal(1, 0.06, (60, DIMS)), rng.uniform(-1, 2, (15, DIMS))])
    rows = spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(x)], "id long, coords array<double>")
    points = numbered_points(rows, "id", "coords", DIMS, EPS)
    fitted = {r["id"]: r["topic"] for r in assign_points(rows, "coords", points, DIMS, EPS, 4).collect()}
    step = rng.uniform(-1, 1, x.shape)
    step *= (EPS / 4 * 0.99) / np.linalg.norm(step, axis=1, keepdims=True)
    moved = spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(x + step)],
                                  "id long, coords array<double>")
    again = {r["id"]: r["topic"] for r in assign_points(moved, "coords", points, DIMS, EPS, 4).collect()}
    side = EPS / (4 * DIMS ** 0.5)
    cores = {tuple(r["point"]) for r in points.collect() if r["core"]}
    clustered = [i for i in fitted if fitted[i] != -1 and tuple(np.floor(x[i] / side).astype(int).tolist()) in cores]
    assert len(clustered) >= 120
    # core points keep their topic; a border point may move beyond eps of every core point
    assert all(again[i] == fitted[i] for i in clustered)
    assert sum(again[i] == fitted[i] for i in fitted) >= 0.95 * len(fitted)


def test_unseen_points_against_brute_force_on_the_lattice(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(0, 0.05, (60, DIMS)), rng.normal(0.6, 0.05, (60, DIMS))])
    rows = spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(x)], "id long, coords array<double>")
    points = numbered_points(rows, "id", "coords", DIMS, EPS).collect()
    side = EPS / (4 * DIMS ** 0.5)
    lattice = np.array([r["point"] for r in points], dtype=float)
    core = np.array([r["core"] for r in points])
    topic = np.array([r["topic"] for r in points])
    queries = rng.uniform(-0.3, 0.9, (200, DIMS))
    frame = spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(queries)],
                                  "id long, coords array<double>")
    got = {r["id"]: r["topic"] for r in assign_points(frame, "coords", spark.createDataFrame(points), DIMS, EPS, 4)
           .collect()}
    q = np.floor(queries / side)
    seen = {tuple(p): t for p, t in zip(lattice.astype(int).tolist(), topic)}
    want = brute_nearest_core(q, lattice, core, topic, 4 * DIMS ** 0.5 + 1e-9)
    for i, p in enumerate(q.astype(int).tolist()):
        assert got[i] == (seen[tuple(p)] if tuple(p) in seen else want[i])
