"""Structured Streaming stages (FIXTURES.md §3: S1, S3, S4, S6)."""

from __future__ import annotations

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from plaudit.plans.queries import load_table
from plaudit.session import session_conf
from plaudit.sources.adapters import reviews_from_events
from plaudit.streaming import (
    run_for,
    score_closed_windows,
    start_summary_stream,
    stream_reviews,
    summarize_stream,
    windowed_scorecard,
)

UTC = datetime.timezone.utc
S1_BASE = datetime.datetime(2024, 5, 1, 22, 12, tzinfo=UTC)


def _s1_files(folder):
    """Nine files; file i has a × (5 + i), b × 2, c × 1; positions 0, 4, 8 … negative."""
    for i in range(9):
        lines = []
        for cat, n in (("a", 5 + i), ("b", 2), ("c", 1)):
            for pos in range(n):
                label = "negative" if pos % 4 == 0 else "positive"
                lines.append(json.dumps({"cuisine": cat, "evaluation": label, "points": 1}))
        path = os.path.join(folder, f"f{i:02d}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        mtime = (S1_BASE + datetime.timedelta(minutes=i)).timestamp()
        os.utime(path, (mtime, mtime))


def _run_arrival(spark, src, out, ckpt, duration, slide=None):
    reviews = stream_reviews(spark, src, time="arrival", max_files_per_trigger=1)
    query = start_summary_stream(summarize_stream(reviews, duration, slide, delay=0), out, ckpt)
    query.awaitTermination()
    assert query.exception() is None
    return query


def _scored_rows(spark, out):
    card = score_closed_windows(spark, out, max_pct_negative=50)
    return sorted(
        (
            r.window_start.strftime("%H:%M"),
            round(r.avg_reviews * 3),  # three categories in every window
            r.category,
            r.reviews,
            r.negatives,
        )
        for r in card.collect()
    )


@pytest.mark.parametrize(
    "duration,slide,expected",
    [
        (
            "1 minute",
            None,
            [("22:12", 8, "a", 5, 2), ("22:13", 9, "a", 6, 2), ("22:14", 10, "a", 7, 2),
             ("22:15", 11, "a", 8, 2), ("22:16", 12, "a", 9, 3), ("22:17", 13, "a", 10, 3),
             ("22:18", 14, "a", 11, 3), ("22:19", 15, "a", 12, 3)],
        ),
        ("4 minutes", None, [("22:12", 38, "a", 26, 8), ("22:16", 54, "a", 42, 12)]),
        (
            "4 minutes",
            "2 minutes",
            [("22:10", 17, "a", 11, 4), ("22:12", 38, "a", 26, 8), ("22:14", 46, "a", 34, 10),
             ("22:16", 54, "a", 42, 12)],
        ),
    ],
)
def test_s1_arrival_windows(spark, scratch, duration, slide, expected):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    _run_arrival(spark, src, out, ckpt, duration, slide)
    assert _scored_rows(spark, out) == expected


def test_s3_restart_writes_nothing_twice(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    _run_arrival(spark, src, out, ckpt, "1 minute")
    first = spark.read.parquet(out).count()
    _run_arrival(spark, src, out, ckpt, "1 minute")
    assert spark.read.parquet(out).count() == first == 8 * 3


S4_TIMES = ["00:00:10", "00:05:00", "00:09:00", "00:00:20", "00:14:00", "00:20:00"]


def _s4_files(folder):
    for i, hms in enumerate(S4_TIMES):
        path = os.path.join(folder, f"r{i}.json")
        row = {"cuisine": "x", "evaluation": "positive", "points": 1, "ts": f"2024-01-01T{hms}Z"}
        with open(path, "w") as fh:
            fh.write(json.dumps(row) + "\n")
        mtime = datetime.datetime(2024, 1, 2, 0, i, tzinfo=UTC).timestamp()
        os.utime(path, (mtime, mtime))


@pytest.mark.parametrize(
    "delay,expected,dropped",
    [
        (0, [("00:00", 1), ("00:04", 1), ("00:08", 1), ("00:12", 1)], 1),
        ("12 minutes", [("00:00", 2), ("00:04", 1)], 0),
    ],
)
def test_s4_late_rows(spark, scratch, delay, expected, dropped):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s4_files(src)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    reviews = stream_reviews(spark, src, max_files_per_trigger=1)
    query = start_summary_stream(summarize_stream(reviews, "4 minutes", delay=delay), out, ckpt)
    query.awaitTermination()
    got = sorted((r.window_start.strftime("%H:%M"), r.reviews) for r in spark.read.parquet(out).collect())
    assert got == expected
    lost = sum(
        op.get("numRowsDroppedByWatermark", 0)
        for p in query.recentProgress
        for op in p.get("stateOperators", [])
    )
    assert lost == dropped


def test_s6_driver_events_stream(spark, scratch):
    sf_dir = "/root/testdata/sf0.01"
    schema = load_table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    summary = summarize_stream(reviews_from_events(events), "4 days", delay=0)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    query = start_summary_stream(summary, out, ckpt)
    query.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 1184
    assert got.select("window_start").distinct().count() == 8
    assert got.schema["window_start"].dataType.typeName() == "timestamp_ntz"
    assert got.agg(F.max("window_end")).first()[0] <= datetime.datetime(2024, 1, 31)


def _s1_with_event_time(folder):
    """S2: S1's rows with a ``ts`` column instead of arrival time."""
    for i in range(9):
        ts = (S1_BASE + datetime.timedelta(minutes=i)).strftime("%Y-%m-%dT%H:%M:%SZ")
        lines = []
        for cat, n in (("a", 5 + i), ("b", 2), ("c", 1)):
            for pos in range(n):
                label = "negative" if pos % 4 == 0 else "positive"
                lines.append(json.dumps({"cuisine": cat, "evaluation": label, "points": 1, "ts": ts}))
        path = os.path.join(folder, f"f{i:02d}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        mtime = (S1_BASE + datetime.timedelta(minutes=i)).timestamp()
        os.utime(path, (mtime, mtime))


def test_s2_event_time_windows(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_with_event_time(src)
    reviews = stream_reviews(spark, src, max_files_per_trigger=1)
    card = windowed_scorecard(
        reviews, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), "4 minutes",
        delay=0, max_pct_negative=50, open_windows=False,
    )
    got = sorted((r.window_start.strftime("%H:%M"), r.category, r.reviews, r.negatives) for r in card.collect())
    assert got == [("22:12", "a", 26, 8), ("22:16", "a", 42, 12)]
    # The default: all windows of a drained backfill, whatever the horizon.
    whole = windowed_scorecard(
        reviews, os.path.join(scratch, "out2"), os.path.join(scratch, "ckpt2"), "4 minutes", max_pct_negative=50
    )
    got = sorted((r.window_start.strftime("%H:%M"), r.category, r.reviews, r.negatives) for r in whole.collect())
    assert got == [("22:12", "a", 26, 8), ("22:16", "a", 42, 12), ("22:20", "a", 13, 4)]


def test_s5_stream_equals_batch(spark):
    from plaudit.plans.queries import scorecard_sliding, stream_sliding

    sf_dir = "/root/testdata/sf0.001"
    stream = {tuple(r) for r in stream_sliding(spark, sf_dir).collect()}
    batch = {tuple(r) for r in scorecard_sliding(spark, sf_dir).collect()}
    assert stream == batch and len(stream) > 0


def test_str9_empty_stream_emits_nothing(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    reviews = stream_reviews(spark, src)
    card = windowed_scorecard(
        reviews, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), "1 minute"
    )
    assert card.collect() == []


def test_live_trigger_and_run_for(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    reviews = stream_reviews(spark, src, time="arrival", max_files_per_trigger=1)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    query = start_summary_stream(
        summarize_stream(reviews, "1 minute", delay=0), out, ckpt, processing_time="1 second"
    )
    deadline = datetime.datetime.now() + datetime.timedelta(seconds=90)
    while datetime.datetime.now() < deadline:
        progress = query.lastProgress
        if progress and progress["batchId"] >= 9 and progress["numInputRows"] == 0:
            break
        query.awaitTermination(1)
    assert run_for(query, 1) is False  # a live query does not end by itself
    assert spark.read.parquet(out).count() == 8 * 3


LATE_SEQUENCE = ["00:00:10", "00:09:00", "00:09:10", "00:07:30", "00:20:00"]


def _late_files(folder):
    """Files in arrival order; 00:07:30 arrives when the watermark Spark uses
    for late rows (two triggers back) is already 00:09."""
    for i, hms in enumerate(LATE_SEQUENCE):
        path = os.path.join(folder, f"r{i}.json")
        row = {"cuisine": "x", "evaluation": "positive", "points": 1, "ts": f"2024-01-01T{hms}Z"}
        with open(path, "w") as fh:
            fh.write(json.dumps(row) + "\n")
        mtime = datetime.datetime(2024, 1, 2, 0, i, tzinfo=UTC).timestamp()
        os.utime(path, (mtime, mtime))


def test_late_row_still_counts_in_open_sliding_windows(spark, scratch):
    """F.window drops a late row only from the windows that ended by the
    late-row watermark; the open window containing it still counts it."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _late_files(src)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    reviews = stream_reviews(spark, src, max_files_per_trigger=1)
    query = start_summary_stream(summarize_stream(reviews, "4 minutes", "2 minutes", delay=0), out, ckpt)
    query.awaitTermination()
    got = sorted((r.window_start.strftime("%H:%M"), r.reviews) for r in spark.read.parquet(out).collect())
    assert got == [("00:00", 1), ("00:06", 3), ("00:08", 2), ("23:58", 1)]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=3, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.integers(min_value=1, max_value=6))
def test_stream_equals_batch_for_any_file_split(spark, seed, n_files):
    """Time-ordered files, one per trigger: the drained stream scores exactly
    as the batch scorecard of the same rows."""
    import random
    import tempfile

    from plaudit.operators import score_summary, summarize_windows

    rnd = random.Random(seed)
    base = datetime.datetime(2024, 3, 1, tzinfo=UTC)
    rows = sorted(
        (base + datetime.timedelta(seconds=rnd.randint(0, 3 * 3600)), rnd.choice("abcdef"),
         rnd.choice(["positive", "negative", "meh"]), rnd.randint(0, 9))
        for _ in range(300)
    )
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    cuts = sorted(rnd.sample(range(1, len(rows)), n_files - 1)) if n_files > 1 else []
    for i, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        path = os.path.join(src, f"f{i:02d}.json")
        with open(path, "w") as fh:
            for ts, cat, ev, pts in rows[lo:hi]:
                fh.write(json.dumps({"cuisine": cat, "evaluation": ev, "points": pts,
                                     "ts": ts.strftime("%Y-%m-%dT%H:%M:%SZ")}) + "\n")
        mtime = (base + datetime.timedelta(minutes=i)).timestamp()
        os.utime(path, (mtime, mtime))
    reviews = stream_reviews(spark, src, max_files_per_trigger=1)
    card = windowed_scorecard(reviews, os.path.join(scratch, "out"), os.path.join(scratch, "ck"),
                              "30 minutes", "10 minutes", delay=0, max_pct_negative=50, late="fail")
    stream = {tuple(r) for r in card.collect()}
    batch_rows = spark.createDataFrame(
        [(cat, ev, pts, ts) for ts, cat, ev, pts in rows],
        "category STRING, evaluation STRING, points BIGINT, ts TIMESTAMP")
    batch = score_summary(summarize_windows(batch_rows, "ts", "30 minutes", "10 minutes"),
                          ["window_start", "window_end"], max_pct_negative=50)
    expected = {tuple(r) for r in batch.collect()}
    assert stream == expected


def test_pane_state_gives_the_same_sliding_windows(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    reviews = stream_reviews(spark, src, time="arrival", max_files_per_trigger=1)
    card = windowed_scorecard(reviews, os.path.join(scratch, "out"), os.path.join(scratch, "ck"),
                              "4 minutes", "2 minutes", delay=0, max_pct_negative=50, panes=True, open_windows=False)
    got = sorted((r.window_start.strftime("%H:%M"), round(r.avg_reviews * 3), r.category, r.reviews, r.negatives)
                 for r in card.collect())
    assert got == [("22:10", 17, "a", 11, 4), ("22:12", 38, "a", 26, 8), ("22:14", 46, "a", 34, 10),
                   ("22:16", 54, "a", 42, 12)]
    panes = spark.read.parquet(os.path.join(scratch, "out"))
    assert {(r.window_end - r.window_start).seconds for r in panes.collect()} == {120}


def test_pane_state_matches_window_state_on_driver_events(spark, scratch):
    from plaudit.plans.queries import stream_sliding

    sf_dir = "/root/testdata/sf0.001"
    schema = load_table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    card = windowed_scorecard(reviews_from_events(events), os.path.join(scratch, "out"),
                              os.path.join(scratch, "ck"), "4 days", "1 day", max_pct_negative=20, panes=True)
    assert {tuple(r) for r in card.collect()} == {tuple(r) for r in stream_sliding(spark, sf_dir).collect()}


def test_pane_state_drops_a_late_row_from_every_window(spark, scratch):
    """With pane state the same late row is dropped from its pane, so from
    every window (00:06 counts 2, not 3): the documented difference."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _late_files(src)
    reviews = stream_reviews(spark, src, max_files_per_trigger=1)
    card = windowed_scorecard(reviews, os.path.join(scratch, "out"), os.path.join(scratch, "ck"),
                              "4 minutes", "2 minutes", delay=0, max_pct_negative=100, volume_rule="ge", panes=True,
                              open_windows=False)
    got = sorted((r.window_start.strftime("%H:%M"), r.reviews) for r in card.collect())
    assert got == [("00:00", 1), ("00:06", 2), ("00:08", 2), ("23:58", 1)]


def test_lenient_stream_routes_rejects(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write('{"cuisine": "x", "evaluation": "positive", "points": "3.9", "ts": "2024-01-01T00:00:10Z"}\n')
        fh.write("{broken\n")
        fh.write('{"cuisine": "x", "evaluation": "positive", "points": "abc", "ts": "2024-01-01T00:00:20Z"}\n')
        fh.write('{"cuisine": "x", "evaluation": "positive", "points": 1, "ts": "2024-01-01T00:09:00Z"}\n')
    good, rejects = stream_reviews(spark, src, mode="lenient")
    rq = rejects.writeStream.format("json").option("path", os.path.join(scratch, "rejects")).option(
        "checkpointLocation", os.path.join(scratch, "rck")).trigger(availableNow=True).start()
    rq.awaitTermination()
    assert sorted(r.reason for r in spark.read.json(os.path.join(scratch, "rejects")).collect()) == [
        "bad points", "malformed"]
    card = windowed_scorecard(good, os.path.join(scratch, "out"), os.path.join(scratch, "ck"), "4 minutes", delay=0)
    summary = spark.read.parquet(os.path.join(scratch, "out")).collect()
    assert [(r.reviews, r.points) for r in summary] == [(1, 3)]
    assert card.collect() == []  # one category per window is never above the average


def test_incremental_report_since(spark, scratch):
    from plaudit.sinks import write_scorecard

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    _run_arrival(spark, src, out, ckpt, "1 minute")
    report = os.path.join(scratch, "report")
    scope = ["window_start", "window_end"]
    first = score_closed_windows(spark, out, 50, since=None).where(F.col("window_end") <= "2024-05-01 22:16:00")
    write_scorecard(first, report, scope=scope, partition_by_scope=True)
    later = score_closed_windows(spark, out, 50, since=datetime.datetime(2024, 5, 1, 22, 16, tzinfo=UTC))
    assert later.count() == 4
    write_scorecard(later, report, scope=scope, partition_by_scope=True, incremental=True)
    assert spark.read.json(report).count() == 8  # earlier windows kept


def test_console_sinks_run(spark, scratch, capsys):
    from plaudit.operators import scorecard
    from plaudit.sinks import show_scorecard

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    reviews = stream_reviews(spark, src, time="arrival")
    query = start_summary_stream(summarize_stream(reviews, "1 minute", delay=0), None, os.path.join(scratch, "ck"), fmt="console")
    query.awaitTermination()
    assert query.exception() is None
    batch = spark.read.schema("cuisine STRING, evaluation STRING, points STRING").json(src)
    card = scorecard(batch.selectExpr("cuisine AS category", "evaluation", "CAST(points AS BIGINT) AS points"), max_pct_negative=50)
    show_scorecard(card)
    assert "rank" in capsys.readouterr().out


def test_s1_with_rocksdb_state(spark, scratch):
    """The large-state setting (RocksDB provider) gives the same windows."""
    from plaudit.session import LARGE_STATE_CONF

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    old = {k: spark.conf.get(k, None) for k in LARGE_STATE_CONF}
    try:
        for key, value in LARGE_STATE_CONF.items():
            spark.conf.set(key, value)
        out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
        _run_arrival(spark, src, out, ckpt, "4 minutes")
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    state_files = [f for _, _, files in os.walk(os.path.join(ckpt, "state")) for f in files]
    assert any(f.endswith(".changelog") for f in state_files)  # RocksDB, not .delta files
    assert _scored_rows(spark, out) == [("22:12", 38, "a", 26, 8), ("22:16", 54, "a", 42, 12)]


def test_stop_midway_then_resume_is_exactly_once(spark, scratch):
    """STR7/STR8: a live query stopped after a few triggers and restarted on
    the same checkpoint ends with exactly the windows of one full run."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    reviews = stream_reviews(spark, src, time="arrival", max_files_per_trigger=1)
    live = start_summary_stream(summarize_stream(reviews, "1 minute", delay=0), out, ckpt, processing_time="1 second")
    deadline = datetime.datetime.now() + datetime.timedelta(seconds=60)
    while datetime.datetime.now() < deadline:
        if live.lastProgress and live.lastProgress["batchId"] >= 3:
            break
        live.awaitTermination(0.5)
    run_for(live, 0.1)
    partial = spark.read.parquet(out).count()
    assert 0 < partial < 8 * 3
    _run_arrival(spark, src, out, ckpt, "1 minute")  # resume, drain
    assert spark.read.parquet(out).count() == 8 * 3
    assert _scored_rows(spark, out)[0] == ("22:12", 8, "a", 5, 2)


def _event_files(folder, rows):
    for i, (hms, *more) in enumerate(rows):
        path = os.path.join(folder, f"r{i:02d}.json")
        row = {"cuisine": "x", "evaluation": "positive", "points": 1, "ts": hms and f"2024-01-01T{hms}Z"} | dict(more)
        with open(path, "w") as fh:
            fh.write(json.dumps(row) + "\n")
        mtime = datetime.datetime(2024, 1, 2, 0, i, tzinfo=UTC).timestamp()
        os.utime(path, (mtime, mtime))


def test_late_rows_are_counted_and_fail_a_strict_run(spark, scratch):
    from plaudit.streaming import late_rows

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    falling = [(f"{10 - i:02d}:00:00",) for i in range(6)]
    _event_files(src, falling)
    reviews = stream_reviews(spark, src, max_files_per_trigger=1)
    with pytest.raises(RuntimeError, match="later than the horizon"):
        windowed_scorecard(reviews, os.path.join(scratch, "o1"), os.path.join(scratch, "c1"), "1 minute",
                           delay=0, late="fail")
    # Within the horizon nothing is lost: every row is in its window.
    card = windowed_scorecard(reviews, os.path.join(scratch, "o2"), os.path.join(scratch, "c2"), "1 hour",
                              volume_rule="ge", late="fail")
    assert card.agg(F.sum("reviews")).first()[0] == 6
    query = start_summary_stream(summarize_stream(reviews, "1 minute", delay=0), os.path.join(scratch, "o3"),
                                 os.path.join(scratch, "c3"))
    query.awaitTermination()
    assert late_rows(query) > 0 and late_rows(query, after_batch=10**6) == 0


def test_a_review_without_a_time_fails(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _event_files(src, [("00:00:10",), (None,)])
    query = start_summary_stream(summarize_stream(stream_reviews(spark, src), "1 minute"),
                                 os.path.join(scratch, "o"), os.path.join(scratch, "c"))
    with pytest.raises(Exception, match="readable time"):
        query.awaitTermination()


def test_open_windows_of_panes_and_offsets(spark, scratch):
    from plaudit.operators import score_summary, summarize_windows

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_with_event_time(src)
    batch = spark.read.schema("cuisine STRING, evaluation STRING, points BIGINT, ts TIMESTAMP").json(src)
    batch = batch.withColumnRenamed("cuisine", "category")
    for i, (panes, start) in enumerate([(True, 0), (False, 60), (True, 60)]):
        reviews = stream_reviews(spark, src, max_files_per_trigger=2)
        card = windowed_scorecard(reviews, os.path.join(scratch, f"o{i}"), os.path.join(scratch, f"c{i}"), "4 minutes",
                                  "2 minutes", delay=0, max_pct_negative=50, panes=panes, start=start)
        windows = summarize_windows(batch, "ts", "4 minutes", "2 minutes", start)
        want = score_summary(windows, ["window_start", "window_end"], max_pct_negative=50)
        assert {tuple(r) for r in card.collect()} == {tuple(r) for r in want.collect()}


def _events_folder(spark, scratch, files):
    """``events`` as a folder of part files instead of one file."""
    load_table(spark, "/root/testdata/sf0.001", "events").repartition(files).write.parquet(f"{scratch}/events.parquet")
    return scratch


@pytest.mark.parametrize("name", ["stream_per_day", "stream_tumbling", "stream_sliding", "stream_sliding_panes"])
def test_stream_queries_read_a_folder_table(spark, scratch, name):
    from plaudit.plans.queries import QUERIES

    folder = _events_folder(spark, scratch, 3)
    got = {tuple(r) for r in QUERIES[name](spark, folder).collect()}
    assert got == {tuple(r) for r in QUERIES[name](spark, "/root/testdata/sf0.001").collect()} and got


def test_backfill_in_many_bounded_batches_equals_the_batch_scorecard(spark, scratch):
    from plaudit.plans import queries

    folder = f"{scratch}/events.parquet"
    load_table(spark, "/root/testdata/sf0.001", "events").repartitionByRange(6, "ts").write.parquet(folder)
    for i, name in enumerate(sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))):
        os.utime(os.path.join(folder, name), (1_700_000_000 + i, 1_700_000_000 + i))
    folder = scratch
    stream = queries._stream(spark, folder, queries.WINDOW, queries.SLIDE, queries.EVENTS_MAX_PCT,
                             options={"maxBytesPerTrigger": "1"})
    assert {tuple(r) for r in stream.collect()} == {
        tuple(r) for r in queries.scorecard_sliding(spark, "/root/testdata/sf0.001").collect()}


def _one_file_batches(folder, n, late_at):
    """``n`` files of one review, a minute of event time apart; one more of them is hours late."""
    for i in range(n):
        ts = datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=i)
        if i == late_at:
            ts -= datetime.timedelta(hours=5)
        with open(os.path.join(folder, f"f{i:04d}.json"), "w") as fh:
            fh.write(json.dumps({"cuisine": "a", "evaluation": "positive", "points": 1, "ts": ts.isoformat() + "Z"}) + "\n")
        os.utime(os.path.join(folder, f"f{i:04d}.json"), (1_700_000_000 + i, 1_700_000_000 + i))


def test_a_late_row_of_an_early_batch_is_not_forgotten(spark, scratch):
    """More batches than the query keeps the progress of: 150, the late row in the sixth."""
    from plaudit.streaming import BatchLedger, start_summary_stream, summarize_stream

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _one_file_batches(src, 150, 5)
    path = lambda name: os.path.join(scratch, name)
    kept = {"spark.sql.streaming.numRecentProgressUpdates": "20", "spark.sql.shuffle.partitions": "1"}
    with session_conf(spark, kept):
        reviews = stream_reviews(spark, src, max_files_per_trigger=1)
        summary = summarize_stream(reviews, 60, delay=60)
        query = start_summary_stream(summary, path("out"), path("checkpoint"))
        ledger = BatchLedger(spark, path("ledger"), every=1.0)
        assert ledger.follow(query)
    found = ledger.account()
    assert len(query.recentProgress) <= 20
    assert (found.rows_read, found.rows_dropped, found.batches_missing) == (150, 1, 0)
    with pytest.raises(RuntimeError, match="late rows"):
        found.check("60 seconds")
    # The next run goes on with the account, and finds a batch that no run has taken.
    again = BatchLedger(spark, path("ledger"))
    assert again.account() == found
    _one_file_batches(src, 153, None)
    again.last -= 2
    again.follow(start_summary_stream(summary, path("out"), path("checkpoint")))
    assert again.account().batches_missing > 0
    with pytest.raises(RuntimeError, match="late rows"):
        again.account().check("60 seconds")


def test_a_missing_batch_fails_a_strict_run():
    from plaudit.streaming import Account

    Account(10, 100, 0, 0).check("a minute")
    with pytest.raises(RuntimeError, match="2 batches are not accounted for"):
        Account(10, 100, 0, 2).check("a minute")


def test_strict_backfill_of_many_batches(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _one_file_batches(src, 30, 5)
    path = lambda name: os.path.join(scratch, name)
    few = {"spark.sql.streaming.numRecentProgressUpdates": "5", "spark.sql.shuffle.partitions": "1"}
    with session_conf(spark, few), pytest.raises(RuntimeError, match="late rows"):
        windowed_scorecard(
            stream_reviews(spark, src, max_files_per_trigger=1), path("out"), path("checkpoint"), 60, delay=60, late="fail"
        )


def test_ticks_move_the_watermark_and_count_nowhere(spark, scratch):
    from plaudit.streaming import ArrivalClock, start_summary_stream, summarize_stream

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _one_file_batches(src, 3, None)
    path = lambda name: os.path.join(scratch, name)
    clock = ArrivalClock(spark, path("ticks"))
    summary = summarize_stream(stream_reviews(spark, src), 60, delay=60, ticks=clock.ticks())

    def drained():
        start_summary_stream(summary, path("out"), path("checkpoint")).awaitTermination()
        return spark.read.schema(summary.schema).parquet(path("out")).agg(F.sum("reviews")).first()[0]

    assert drained() == 1  # the newest file's time less the delay closes the first minute
    clock._write(datetime.datetime(2024, 1, 1, 1, tzinfo=datetime.timezone.utc))
    assert drained() == 3
    assert ArrivalClock(spark, path("ticks")).last == clock.last
