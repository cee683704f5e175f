"""Batch time scopes: pane-built windows equal Spark's own ``F.window`` windows."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from plaudit.operators import summarize, summarize_windows, windows, with_day
from plaudit.operators.windows import pane_seconds, parse_seconds, windows_from_panes

BASE = datetime.datetime(2024, 3, 1, 5, 17, 0)


def _reviews(spark, n=400, seed=3, ntz=True):
    rnd = random.Random(seed)
    rows = [
        (
            rnd.choice("abcde"),
            rnd.choice(["positive", "negative", "meh"]),
            rnd.randint(0, 9),
            BASE + datetime.timedelta(seconds=rnd.randint(0, 20 * 86400)),
        )
        for _ in range(n)
    ]
    rows.append(("a", "positive", 1, None))  # no time: in no window
    kind = "TIMESTAMP_NTZ" if ntz else "TIMESTAMP"
    return spark.createDataFrame(rows, f"category STRING, evaluation STRING, points BIGINT, ts {kind}")


def _brute(df, w, s, start):
    """Spark's own sliding windows (Expand of every row), then AGG1."""
    if s <= w:
        win = F.window("ts", f"{w} seconds", f"{s} seconds", f"{start} seconds")
        rows = df.where(F.col("ts").isNotNull()).withColumn("_w", win)
    else:
        win = F.window("ts", f"{s} seconds", startTime=f"{start} seconds")
        rows = df.where(F.col("ts").isNotNull()).withColumn("_w", win)
        rows = rows.where(F.col("ts") < F.col("_w.start") + F.expr(f"INTERVAL {w} SECONDS"))
    got = summarize(rows.withColumn("window_start", F.col("_w.start")), ["window_start"])
    return {(r.window_start, r.category, r.reviews, r.negatives, r.points) for r in got.collect()}


@pytest.mark.parametrize(
    "w,s,start",
    [
        (4 * 86400, 4 * 86400, 0),  # tumbling
        (4 * 86400, 86400, 0),  # sliding, pane = slide
        (6 * 3600, 4 * 3600, 0),  # sliding, pane = gcd = 2 h
        (86400, 2 * 86400, 0),  # sampling
        (3 * 86400, 86400, 3600),  # start offset
        (6 * 3600, 4 * 3600, 3 * 3600),  # offset longer than the 2 h pane
    ],
)
@pytest.mark.parametrize("ntz", [True, False])
def test_panes_equal_spark_windows(spark, w, s, start, ntz):
    df = _reviews(spark, ntz=ntz)
    got = summarize_windows(df, "ts", w, s, start, missing_time="drop")
    assert got.columns == ["window_start", "window_end", "category", "reviews", "negatives", "points"]
    rows = got.collect()
    assert all(r.window_end - r.window_start == datetime.timedelta(seconds=w) for r in rows)
    mine = {(r.window_start, r.category, r.reviews, r.negatives, r.points) for r in rows}
    assert mine == _brute(df, w, s, start)


@pytest.mark.parametrize(
    "w,s,start",
    [
        (4 * 86400, 86400, 0),
        (6 * 3600, 4 * 3600, 3 * 3600),  # panes shorter than the slide
        (86400, 2 * 86400, 0),  # sampling: some panes are in no window
        (10 * 86400, 3600, 1800),  # 240 windows hold a pane
    ],
)
@pytest.mark.parametrize("ntz", [True, False])
def test_running_sums_equal_spark_windows(spark, w, s, start, ntz, monkeypatch):
    monkeypatch.setattr(windows, "CHUNK_SLIDES", 7)  # many chunks, also empty ones between
    df = _reviews(spark, n=60, ntz=ntz).union(_reviews(spark, n=3, seed=8, ntz=ntz).withColumn("category", F.lit(None)))
    pane = pane_seconds(w, s)
    panes = summarize(
        df.where("ts is not null").withColumn(
            "pane_start", F.window("ts", f"{pane} seconds", startTime=f"{start % pane} seconds").getField("start")
        ),
        ["pane_start"],
    )
    found = windows_from_panes(panes, w, s, start, method="sums")
    assert found.dtypes == windows_from_panes(panes, w, s, start, method="expand").dtypes
    rows = found.collect()
    assert len({(r.window_start, r.category) for r in rows}) == len(rows)
    assert {(r.window_start, r.category, r.reviews, r.negatives, r.points) for r in rows} == _brute(df, w, s, start)


def test_windows_of_many_slides_write_out_results_only(spark):
    """30 days by the minute: 43,200 windows hold each pane, and nothing else is expanded."""
    day = datetime.datetime(2024, 1, 1)
    rows = [("a", "positive", 2, day + datetime.timedelta(seconds=7 * i)) for i in range(200)]
    df = spark.createDataFrame(rows, "category STRING, evaluation STRING, points BIGINT, ts TIMESTAMP_NTZ")
    got = summarize_windows(df, "ts", "30 days", "1 minute")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 3  # two changes a pane, for rows and chunks, and the results
    n = got.agg(F.count(F.lit(1)), F.max("reviews"), F.min("reviews"), F.sum("points")).first()
    # The panes lie in 24 minutes: each of them starts 43,200 windows.
    assert n[0] == 43_200 + 23 and n[1] == 200 and n[2] >= 1 and n[3] == 200 * 2 * 43_200
    with pytest.raises(ValueError, match="method"):
        windows_from_panes(df, 60, method="guess")


def test_a_review_without_a_time_fails_by_default(spark):
    with pytest.raises(Exception, match="review without a time"):
        summarize_windows(_reviews(spark, n=5), "ts", "1 day").collect()
    with pytest.raises(ValueError, match="missing_time"):
        summarize_windows(_reviews(spark, n=5), "ts", "1 day", missing_time="skip")


def test_with_day(spark):
    df = _reviews(spark, n=50)
    got = summarize(with_day(df), ["day"])
    total = got.agg(F.sum("reviews")).first()[0]
    assert total == 51  # the row without a time forms the null day
    assert got.schema["day"].dataType.typeName() == "date"


def test_parse_seconds():
    assert parse_seconds("4 days") == 345600
    assert parse_seconds("90 minutes") == 5400
    assert parse_seconds(7) == 7
    assert parse_seconds("7d") == parse_seconds("7 days") == parse_seconds("1 week") == 604800
    assert parse_seconds("15 s") == parse_seconds("15 Seconds") == 15 and parse_seconds("2h") == 7200
    for wrong in ("3 fortnights", "days", "3", "-1 day", "1.5 days"):
        with pytest.raises(ValueError):
            parse_seconds(wrong)


def test_ntz_conversions_ignore_the_session_time_zone(spark):
    from plaudit.functions.time import instant_to_ntz, ntz_to_instant

    df = spark.createDataFrame([(datetime.datetime(2024, 1, 2, 3, 4, 5),)], "ts TIMESTAMP_NTZ")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            row = df.select(
                F.unix_micros(ntz_to_instant(F.col("ts"))).alias("us"),
                instant_to_ntz(ntz_to_instant(F.col("ts"))).alias("back"),
            ).first()
            assert row.us == 1704164645 * 1_000_000
            assert row.back == datetime.datetime(2024, 1, 2, 3, 4, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
