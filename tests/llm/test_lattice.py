import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaudit.llm import lattice
from plaudit.llm.lattice import LatticeTables, near_vectors, nearest_e8, shortest_vectors


def test_e8_points():
    near = shortest_vectors()
    assert near.shape == (240, 8) and np.allclose((near**2).sum(1), 2)
    rng = np.random.default_rng(0)
    y = rng.normal(size=(300, 8)) * 2
    p = nearest_e8(y)
    assert np.allclose(nearest_e8(p), p)
    best = ((y - p) ** 2).sum(1)
    assert best.max() <= 1 + 1e-9  # the covering radius of E8 is 1
    for v in near:  # no neighbour is closer: the point found is the nearest one
        assert (((y - p - v) ** 2).sum(1) >= best - 1e-9).all()


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    hashing, found = LatticeTables(64), np.zeros(3000, bool)
    for t in range(hashing.tables):
        (a, pa), (b, pb) = hashing.cells(x, t), hashing.cells(y, t)
        found |= (a == b) | (pa == b[:, None]).any(1) | (pb == a[:, None]).any(1)
    assert found.mean() >= 0.95


def brute(rows, threshold=0.9):
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v is not None and np.linalg.norm(v) > 0}
    links, comp = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}
    for a, b in itertools.combinations(unit, 2):
        if unit[a] @ unit[b] >= threshold:
            links[a] += 1
            links[b] += 1
            low, high = sorted((comp[a], comp[b]))
            comp = {k: low if c == high else c for k, c in comp.items()}
    return links, comp


@pytest.mark.parametrize("cell_rows", [512, 3])
def test_same_as_brute_force(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(lattice, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(lattice, "TASK_ROWS", 60)
    rng = np.random.default_rng(5)
    rows, centers = [], rng.normal(size=(12, 16))
    for i in range(150):
        c = centers[i % 12]
        rows.append((i, (c + rng.normal(size=16) * 0.02 if i % 3 else c).astype(np.float32).tolist()))
    rows += [(200 + i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    links, comp = brute(rows)
    got = {r.vec_id: r for r in near_vectors(df).collect()}
    assert len(got) == len(rows)
    for i in links:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links[i], comp[i], comp[i] == i)


def test_edge_cases(spark):
    nan = float("nan")
    rows = [(3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0])]
    rows += [(8, [None, 1.0]), (9, [float("inf"), 0.0]), (10, [-1.0, 0.0]), (11, [1.0]), (None, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("clash"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    assert len(got) == len(rows)
    assert got[1] == got[2] == got[3] == got[11] == (3, 1)
    for i in (4, 5, 6, 7, 8, 9, 10):
        assert got[i] == (0, i)
    assert near_vectors(df.limit(0)).count() == 0
