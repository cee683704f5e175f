"""Batch scorecard on literal reviews (FIXTURES.md §2, F1-F6, F8)."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from plaudit.operators import (
    ordinal_rank,
    scope_totals,
    score_summary,
    scorecard,
    summarize,
    with_scope_totals,
)
from plaudit.schema import SCORECARD_COLUMNS
from tests.conftest import reviews_df

F1 = [
    ("Thai", "positive", 5),
    ("Thai", "NEGATIVE", 3),
    ("Thai", "Positive", 4),
    ("Thai", "neutral", 9),
    ("Pizza", "positive", 7),
    ("Pizza", "positive", 2),
    ("Pizza", "positive", 1),
    ("Pizza", "positive", 1),
    ("Donuts", "negative", 2),
    (None, "positive", 1),
]


def _by_category(df):
    return {r["category"]: r for r in df.collect()}


def test_f1_summary(spark):
    got = _by_category(summarize(reviews_df(spark, F1)))
    assert {k: (r.reviews, r.negatives, r.points) for k, r in got.items()} == {
        "Thai": (4, 1, 6),
        "Pizza": (4, 0, 11),
        "Donuts": (1, 1, -2),
        None: (1, 0, 1),
    }


def test_f1_totals_count_the_null_group(spark):
    row = scope_totals(summarize(reviews_df(spark, F1))).collect()[0]
    assert (row.scope_reviews, row.scope_categories, row.avg_reviews) == (10, 4, 2.5)


def test_f1_threshold_30_and_25(spark):
    card = scorecard(reviews_df(spark, F1), max_pct_negative=30)
    rows = sorted(card.collect(), key=lambda r: r["rank"])
    assert [(r.category, r.avg_points, r.pct_negative, r["rank"]) for r in rows] == [
        ("Pizza", 2.75, 0.0, 1),
        ("Thai", 1.5, 25.0, 2),
    ]
    assert rows[0].avg_reviews == 2.5
    card25 = scorecard(reviews_df(spark, F1), max_pct_negative=25)
    assert [r.category for r in card25.collect()] == ["Pizza"]


def _f2(spark):
    rows = [("X", "positive", 2)] * 10 + [("Y", "positive", 3)] * 5
    rows += [("Z", "positive", 1), ("W", "positive", 1)]
    return reviews_df(spark, rows)


def test_f2_sort_key(spark):
    by_points = scorecard(_f2(spark), max_pct_negative=10, order_by="points")
    assert [r.category for r in by_points.orderBy("rank").collect()] == ["X", "Y"]
    by_avg = scorecard(_f2(spark), max_pct_negative=10)
    assert [(r.category, r.avg_points) for r in by_avg.orderBy("rank").collect()] == [
        ("Y", 3.0),
        ("X", 2.0),
    ]
    assert by_avg.first().avg_reviews == 4.25


def test_f3_volume_boundary(spark):
    df = reviews_df(spark, [("P", "positive", 1)] * 3 + [("Q", "positive", 1)] * 3)
    assert scorecard(df, max_pct_negative=10).count() == 0
    assert scorecard(df, max_pct_negative=10, volume_rule="ge").count() == 2


def test_f4_float_edge(spark):
    rows = [("A", "negative", 1)] * 29 + [("A", "positive", 1)] * 71 + [("B", "positive", 1)]
    kept = scorecard(reviews_df(spark, rows), max_pct_negative=29).collect()
    assert [r.category for r in kept] == ["A"]
    assert kept[0].pct_negative == 28.999999999999996
    rows7 = [("A", "negative", 1)] * 7 + [("A", "positive", 1)] * 93 + [("B", "positive", 1)]
    assert scorecard(reviews_df(spark, rows7), max_pct_negative=7).count() == 0


def test_f5_ties_rank_by_category(spark):
    rows = [("b", "positive", 2)] * 4 + [("a", "positive", 2)] * 4 + [("c", "positive", 1)]
    card = scorecard(reviews_df(spark, rows), max_pct_negative=10)
    assert [(r.category, r["rank"]) for r in card.orderBy("rank").collect()] == [("a", 1), ("b", 2)]


def test_f6_empty_input(spark):
    card = scorecard(reviews_df(spark, []), max_pct_negative=10)
    assert card.collect() == []
    assert card.columns == list(SCORECARD_COLUMNS)
    scoped = scorecard(reviews_df(spark, []).withColumn("day", F.current_date()), ["day"])
    assert scoped.collect() == [] and scoped.columns == ["day", *SCORECARD_COLUMNS]


def test_f8_published_example(spark):
    rows = [("Donuts", "positive", 9)] * 15 + [("Donuts", "positive", 2)]
    rows += [("Bagels", "positive", 1)] * 4
    card = scorecard(reviews_df(spark, rows), max_pct_negative=10).collect()
    assert [(r.category, r.reviews, r.negatives, r.points, r.avg_points) for r in card] == [
        ("Donuts", 16, 0, 137, 8.5625)
    ]


def test_neutral_and_null_labels_count_as_reviews(spark):
    rows = [("A", None, 5), ("A", "meh", 5), ("A", " negative", 5), ("A", "positive", 1)]
    got = summarize(reviews_df(spark, rows)).collect()[0]
    assert (got.reviews, got.negatives, got.points) == (4, 0, 1)


def test_scope_totals_per_scope(spark):
    rows = [("a", "positive", 1, 1), ("b", "positive", 1, 1), ("a", "positive", 1, 2)]
    df = spark.createDataFrame(rows, "category STRING, evaluation STRING, points BIGINT, day INT")
    got = {(r.day, r.category): (r.scope_reviews, r.scope_categories, r.avg_reviews)
           for r in with_scope_totals(summarize(df, ["day"]), ["day"]).collect()}
    assert got == {(1, "a"): (2, 2, 1.0), (1, "b"): (2, 2, 1.0), (2, "a"): (1, 1, 1.0)}


def test_null_scope_meets_its_totals(spark):
    rows = [("a", "positive", 1, None), ("b", "positive", 1, None), ("a", "positive", 1, 2)]
    df = spark.createDataFrame(rows, "category STRING, evaluation STRING, points BIGINT, day INT")
    got = with_scope_totals(summarize(df, ["day"]), ["day"]).where(F.col("day").isNull())
    assert sorted((r.category, r.scope_categories) for r in got.collect()) == [("a", 2), ("b", 2)]


@pytest.mark.parametrize("scoped", [False, True])
def test_ordinal_rank_matches_row_number_over_many_partitions(spark, scoped):
    rnd = random.Random(7)
    rows = [(f"c{i:04d}", rnd.randint(0, 20), rnd.choice([1, 2, 2, 3])) for i in range(3000)]
    df = spark.createDataFrame(rows, "category STRING, score INT, grp INT")
    scope = ["grp"] if scoped else []
    order = [F.col("score").desc(), F.col("category").asc_nulls_first()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordinal_rank(df, order, scope)
        expected = df.withColumn(
            "expected",
            F.row_number().over(Window.partitionBy(*scope).orderBy(*order)),
        )
        joined = got.join(expected, ["category"])
        assert joined.where(F.col("rank") != F.col("expected")).count() == 0
        assert got.count() == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=4, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_scope_equivalence(spark, seed):
    """scorecard(S=[b]) equals scorecard(S=[]) of every batch b on its own."""
    rnd = random.Random(seed)
    labels = ["positive", "negative", "Positive", "meh"]
    rows = [
        (rnd.choice("abcdefg"), rnd.choice(labels), rnd.randint(0, 9), rnd.randint(1, 3))
        for _ in range(rnd.randint(1, 120))
    ]
    df = spark.createDataFrame(rows, "category STRING, evaluation STRING, points BIGINT, b INT")
    scoped = {tuple(r) for r in scorecard(df, ["b"], max_pct_negative=40).collect()}
    each = set()
    for b in {r[3] for r in rows}:
        part = scorecard(df.where(F.col("b") == b), max_pct_negative=40)
        each |= {(b, *tuple(r)) for r in part.collect()}
    assert scoped == each


def test_score_summary_merges_partial_summaries(spark):
    """A pre-aggregated summary scores like the raw reviews (used before joins)."""
    df = reviews_df(spark, F1)
    direct = {tuple(r) for r in scorecard(df, max_pct_negative=30).collect()}
    via = {tuple(r) for r in score_summary(summarize(df), max_pct_negative=30).collect()}
    assert direct == via


def test_brand_summary_equals_row_level_path(spark):
    from plaudit.sources import brand_summary, load_table, reviews_from_lineitem

    from tests.conftest import SF_SMALL

    lineitem, part = load_table(spark, SF_SMALL, "lineitem"), load_table(spark, SF_SMALL, "part")
    early = {tuple(r) for r in brand_summary(lineitem, part).collect()}
    late = {tuple(r) for r in summarize(reviews_from_lineitem(lineitem, part)).collect()}
    assert early == late and len(early) == 25


@pytest.mark.parametrize("partitions", [1, 3, 11])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    rnd = random.Random(11)
    rows = [(rnd.choice("abcdefghij"), rnd.choice(["positive", "negative", "x"]), rnd.randint(0, 9), rnd.randint(1, 4))
            for _ in range(500)]
    df = spark.createDataFrame(rows, "category STRING, evaluation STRING, points BIGINT, b INT")
    base = {tuple(r) for r in scorecard(df.coalesce(1), ["b"], max_pct_negative=45).collect()}
    split = {tuple(r) for r in scorecard(df.repartition(partitions), ["b"], max_pct_negative=45).collect()}
    assert base == split and len(base) > 0


def test_bad_arguments_fail_before_any_job(spark):
    df = reviews_df(spark, F1)
    with pytest.raises(ValueError, match="order_by"):
        scorecard(df, order_by="reviews")
    with pytest.raises(ValueError, match="volume_rule"):
        scorecard(df, volume_rule="gte")
