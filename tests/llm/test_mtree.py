import numpy as np
import pytest
from pyspark.sql import functions as F

from plaudit.llm import mtree
from plaudit.llm.mtree import build_node, search, top_inner_products


def by_hand(rows, k, every):
    out = []
    for qid, q in rows:
        if qid % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(q, x, strict=True)), i) for i, x in rows if i != qid)
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def vectors(n, dim=6, seed=0, levels=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    return np.round(x * levels) / levels if levels else x


@pytest.mark.parametrize("levels", [None, 1])
def test_same_as_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(mtree, "NODE_ROWS", 60)
    monkeypatch.setattr(mtree, "PAGE_ROWS", 8)
    monkeypatch.setattr(mtree, "QUERY_ROWS", 10)
    x = vectors(400, levels=levels)  # one level: many ties and equal vectors
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, top_inner_products(df, F.col("vec_id") % 7 == 0).collect()))
    ints = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in enumerate(x)]
    assert got == by_hand(ints, 5, 7)


def test_bounds_skip_work():
    rng = np.random.default_rng(3)
    centers = rng.integers(-200, 200, size=(12, 8))
    x = (np.repeat(centers, 50, axis=0) + rng.integers(-3, 4, size=(600, 8))).astype(np.float64)
    most = float((x * x).sum(1).max())
    node = build_node(np.arange(600), x, most, page_rows=20)
    assert len(node["page_end"]) >= 12 and sorted(node["ids"]) == list(range(600))

    class Counted(np.ndarray):
        seen = 0

        def __matmul__(self, other):
            Counted.seen += len(self)
            return np.asarray(self) @ other

    node["x"] = node["x"].view(Counted)
    q = x[17]
    got = sorted(search([node], 17, q, most, 5), key=lambda p: (-p[0], p[1]))
    want = sorted(((float(s), i) for i, s in enumerate(x @ q) if i != 17), key=lambda p: (-p[0], p[1]))[:5]
    assert got == want
    assert Counted.seen < 300  # of 600 entries


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.5]), (100, None), (150, []), (200, [nan, 1.0]), (250, [inf, 0.0]), (1, [0.0, 0.0])]
    rows += [(300, [None, 1.0]), (None, [1.0, 1.0]), (50, [0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash"))
    got = sorted(map(tuple, top_inner_products(df, F.col("vec_id") % 50 == 0).collect()))
    assert got == [(0, 1, 50, 32768), (0, 2, 50, 32768), (0, 3, 1, 0), (50, 1, 0, 32768), (50, 2, 1, 0)]
    assert top_inner_products(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert top_inner_products(one, F.col("vec_id") % 50 == 0).count() == 0
