"""Skewed input against a brute-force scorecard written in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict

from plaudit.operators import scorecard
from tests.conftest import reviews_df


def brute_force(rows, max_pct, rule="gt", order_by="avg_points"):
    """rows: (scope, category, evaluation, points) → set of scorecard tuples."""
    groups = defaultdict(lambda: [0, 0, 0])
    for scope, cat, ev, pts in rows:
        g = groups[(scope, cat)]
        g[0] += 1
        label = ev.lower() if ev is not None else None
        if label == "negative":
            g[1] += 1
            g[2] -= pts
        elif label == "positive":
            g[2] += pts
    per_scope = defaultdict(list)
    for (scope, cat), (n, neg, pts) in groups.items():
        per_scope[scope].append((cat, n, neg, pts))
    out = set()
    for scope, cats in per_scope.items():
        avg = sum(c[1] for c in cats) / len(cats)
        kept = []
        for cat, n, neg, pts in cats:
            pct = neg / n * 100.0
            popular = n > avg if rule == "gt" else n >= avg
            if popular and pct < max_pct:
                kept.append((cat, n, neg, pts, pct, avg, pts / n))
        key = (lambda k: (-k[6], k[0])) if order_by == "avg_points" else (lambda k: (-k[3], k[0]))
        for rank, k in enumerate(sorted(kept, key=key), start=1):
            out.add((scope, *k, rank))
    return out


def _skewed(seed=5, n=6000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            cat, scope = "hot", 1  # a third of all reviews in one category
        else:
            scope = 1 if rnd.random() < 0.8 else rnd.randint(2, 4)  # one scope holds most
            cat = f"c{rnd.randint(0, 400)}"
        ev = rnd.choice(["positive", "negative", "Positive", "neutral", "positive"])
        rows.append((scope, cat, ev, rnd.randint(0, 9)))
    return rows


def test_skewed_scorecard_matches_brute_force(spark):
    rows = _skewed()
    df = spark.createDataFrame(rows, "b INT, category STRING, evaluation STRING, points BIGINT")
    got = {tuple(r) for r in scorecard(df, ["b"], max_pct_negative=45).collect()}
    assert got == brute_force(rows, 45) and len(got) > 50


def test_whole_data_set_by_points_matches_brute_force(spark):
    rows = [(None, c, e, p) for _, c, e, p in _skewed(seed=9, n=3000)]
    df = reviews_df(spark, [(c, e, p) for _, c, e, p in rows])
    got = {(None, *tuple(r)) for r in scorecard(df, max_pct_negative=45, order_by="points").collect()}
    assert got == brute_force(rows, 45, order_by="points")
