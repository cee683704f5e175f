"""Summaries kept up to date, totals joined inside the stream, streams found again."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from plaudit.operators.scorecard import scorecard
from plaudit.operators.summarize import summarize
from plaudit.sources import read_reviews
from plaudit.streaming import (
    ArrivalClock,
    maintained_scorecard,
    manifest_of,
    read_maintained,
    scored_stream,
    start_or_recover,
    start_summary_stream,
    stream_reviews,
    summarize_stream,
    update_summary,
    windowed_scorecard,
)


def _file(folder, name, rows):
    with open(os.path.join(folder, name), "w") as fh:
        fh.writelines(json.dumps(r) + "\n" if isinstance(r, dict) else r + "\n" for r in rows)


def _rows(seed, n=30, ts=False):
    out = []
    for i in range(n):
        k = (seed * 7 + i * i) % 11
        row = {"cuisine": [None, "a", "b", "c"][k % 4], "evaluation": ["Positive", "negative", "meh"][i % 3], "points": k}
        out.append(row | ({"ts": f"2024-01-{1 + (seed + i) % 20:02d}T{k:02d}:10:00Z"} if ts else {}))
    return out


def test_each_run_reads_new_files_only(spark, scratch):
    src, state = os.path.join(scratch, "in"), os.path.join(scratch, "state")
    os.makedirs(src)
    _file(src, "f0.json", _rows(0))
    assert update_summary(stream_reviews(spark, src, time="arrival"), state).rows_read == 30
    for i in range(1, 4):
        _file(src, f"f{i}.json", _rows(i, 20 + i))
        reviews = stream_reviews(spark, src, time="arrival", max_files_per_trigger=1)
        assert update_summary(reviews, state).rows_read == 20 + i
        want = summarize(read_reviews(spark, src))
        got = read_maintained(spark, state)
        assert got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert update_summary(stream_reviews(spark, src, time="arrival"), state).rows_read == 0
    card = maintained_scorecard(stream_reviews(spark, src, time="arrival"), state, max_pct_negative=60, order_by="points")
    want = scorecard(read_reviews(spark, src), max_pct_negative=60, order_by="points")
    assert card.collect() == want.orderBy("rank").collect() and card.count() > 0


def test_a_failed_run_is_merged_once(spark, scratch):
    src, state = os.path.join(scratch, "in"), os.path.join(scratch, "state")
    os.makedirs(src)
    _file(src, "f0.json", _rows(0))
    update_summary(stream_reviews(spark, src, time="arrival"), state)
    _file(src, "f1.json", [*_rows(1), "{broken"])
    with pytest.raises(Exception):
        update_summary(stream_reviews(spark, src, time="arrival"), state)
    assert read_maintained(spark, state).agg(F.sum("reviews")).first()[0] == 30
    _file(src, "f1.json", _rows(1))  # mended in place
    update_summary(stream_reviews(spark, src, time="arrival"), state)
    assert read_maintained(spark, state).agg(F.sum("reviews")).first()[0] == 60


@pytest.mark.parametrize("duration,slide,start", [(2 * 86400, 2 * 86400, 0), (3 * 86400, 86400, 3600)])
def test_totals_joined_in_the_stream(spark, scratch, duration, slide, start):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for i in range(3):
        _file(src, f"f{i}.json", _rows(i, 60, ts=True))
    path = lambda name: os.path.join(scratch, name)
    clock = ArrivalClock(spark, path("ticks"))
    kept = scored_stream(
        stream_reviews(spark, src), duration, slide, "30 days", 50.0, "ge", start=start, ticks=clock.ticks()
    )
    start_summary_stream(kept, path("kept"), path("checkpoint")).awaitTermination()
    assert spark.read.schema(kept.schema).parquet(path("kept")).count() == 0  # all windows are open
    clock.close()
    start_summary_stream(kept, path("kept"), path("checkpoint")).awaitTermination()
    want = windowed_scorecard(
        stream_reviews(spark, src), path("out"), path("checkpoint2"), duration, slide, "30 days", 50.0, "ge", start=start
    ).drop("rank")
    got = spark.read.schema(kept.schema).parquet(path("kept")).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 5


def test_a_running_query_is_given_back(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    path = lambda name: os.path.join(scratch, name)
    summary = summarize_stream(stream_reviews(spark, src), 60)
    manifest = manifest_of(summary, window=60)
    begin = lambda name: start_summary_stream(summary, path("out"), path("cp"), False, "1 second", name)
    first = start_or_recover(spark, "once", path("manifest"), manifest, begin)
    try:
        assert start_or_recover(spark, "once", path("manifest"), manifest, begin).id == first.id
        with pytest.raises(ValueError, match="window: '60' there, '61' now"):
            start_or_recover(spark, "once", path("manifest"), manifest | {"window": "61"}, begin)
    finally:
        first.stop()
    second = start_or_recover(spark, "once", path("manifest"), manifest, begin)
    assert second.runId != first.runId and second.id == first.id  # recovered from its checkpoint
    second.stop()
