"""STR6: the bounded history of the stage-1 table."""

import datetime
import glob
import os
import time

import pytest

from plaudit.apps import run
from plaudit.streaming import History, start_summary_stream, stream_reviews, summarize_stream
from plaudit.streaming.windowed import read_summary
from tests.test_apps import _minute_files, _window_folders

SCHEMA = "window_start TIMESTAMP, window_end TIMESTAMP, category STRING, reviews BIGINT, negatives BIGINT, points BIGINT"
UTC = datetime.timezone.utc
START = datetime.datetime(2024, 5, 1, tzinfo=UTC)


def _windows(spark, hours, per=2, ntz=False):
    """``per`` categories in each hour-long window that begins in ``hours``."""
    kind = "TIMESTAMP_NTZ" if ntz else "TIMESTAMP"
    hour = datetime.timedelta(hours=1)
    start = START.replace(tzinfo=None) if ntz else START
    rows = [(start + h * hour, start + (h + 1) * hour, f"c{i}" if i else None, h + 1, i, 3) for h in hours for i in range(per)]
    return spark.createDataFrame(rows, SCHEMA.replace("TIMESTAMP", kind))


def _rows(df):
    return sorted(map(repr, df.collect()))


def _files(path):
    return glob.glob(f"{path}/**/part-*", recursive=True)


@pytest.mark.parametrize("ntz", [False, True])
def test_history_and_rest_are_the_table(spark, scratch, ntz):
    every = _windows(spark, range(60), ntz=ntz)
    history = History(spark, f"{scratch}/h", every.schema)
    assert history.read().isEmpty() and _rows(history.read(every)) == _rows(every)
    assert not history.compact(every.limit(0))  # an empty table makes no entry
    assert not os.path.exists(f"{scratch}/h/log")
    for until in (10, 11, 30):
        assert history.compact(_windows(spark, range(until), ntz=ntz))
        assert not history.compact(_windows(spark, range(until), ntz=ntz))  # nothing new
    # What a restarted reader finds: each window once, whatever the table still lists.
    again = History(spark, f"{scratch}/h", every.schema)
    assert again.now == history.now
    assert _rows(again.read()) == _rows(_windows(spark, range(30), ntz=ntz))
    assert _rows(again.read(every)) == _rows(every)
    assert _rows(again.read(_windows(spark, range(29, 60), ntz=ntz))) == _rows(every)
    assert again.read(every).schema == every.schema


def test_runs_grow_with_the_logarithm(spark, scratch):
    history = History(spark, f"{scratch}/h", _windows(spark, [0]).schema, period="100 days")
    for h in range(12):
        history.compact(_windows(spark, [h]))
        assert len(history.now.runs) <= 4
        # Those of the entry before may still be there.
        assert len(_files(f"{scratch}/h/data")) <= 10 and len(_files(f"{scratch}/h/log")) <= 2
    assert sum(r.n for r in history.now.runs) == 24
    assert _rows(history.read()) == _rows(_windows(spark, range(12)))


def test_full_runs_are_left_and_hot_windows_split(spark, scratch):
    history = History(spark, f"{scratch}/h", _windows(spark, [0]).schema, rows_per_file=50, full_rows=200)
    history.compact(_windows(spark, [0], per=190))
    first = history.now.runs[0]
    assert 3 <= len(_files(f"{scratch}/h/data")) <= 5  # one window, one period
    history.compact(_windows(spark, [1], per=150))
    assert history.now.runs[0] == first and len(history.now.runs) == 2
    assert history.read().count() == 340


def test_periods_expire(spark, scratch):
    history = History(spark, f"{scratch}/h", _windows(spark, [0]).schema)
    history.expire(START)  # nothing to expire
    history.compact(_windows(spark, range(72)))
    before = history.read()
    history.expire(START + datetime.timedelta(hours=50))
    assert history.now.expired_micros == int((START + datetime.timedelta(days=2)).timestamp()) * 1_000_000
    # A window that ends on midnight lies in the day that begins then.
    assert _rows(history.read()) == _rows(_windows(spark, range(47, 72)))
    assert before.count() == 144  # the entry before stays readable
    history.expire(START + datetime.timedelta(hours=49))  # no further
    history.compact(_windows(spark, range(47, 73)))
    days = {d.rsplit("=", 1)[-1] for d in glob.glob(f"{scratch}/h/data/*/period=*")}
    assert len(days) == 2
    # Expired windows that the table still lists don't come back.
    assert _rows(History(spark, f"{scratch}/h", before.schema).read(_windows(spark, range(73)))) == _rows(_windows(spark, range(47, 73)))
    history.expire(START + datetime.timedelta(days=9))
    assert history.now.runs == () and history.read().isEmpty()


def test_a_writer_lost_before_its_entry(spark, scratch, monkeypatch):
    schema = _windows(spark, [0]).schema
    history = History(spark, f"{scratch}/h", schema)
    history.compact(_windows(spark, range(4)))
    with monkeypatch.context() as m:
        m.setattr(History, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError, match="driver lost"):
            history.compact(_windows(spark, range(9)))
    again = History(spark, f"{scratch}/h", schema)
    assert _rows(again.read()) == _rows(_windows(spark, range(4)))
    again.compact(_windows(spark, range(9)))
    assert _rows(again.read()) == _rows(_windows(spark, range(9)))
    assert {os.path.basename(d)[4:] for d in glob.glob(f"{scratch}/h/data/run=*")} <= {
        r.folder for v in again.versions for r in v.runs
    }


def test_a_stream_of_many_batches(spark, scratch):
    """One file a batch; the sink forgets its files by age, the history keeps every window."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    out, ckpt = f"{scratch}/summaries", f"{scratch}/checkpoint"

    def drain(minutes, retention=None):
        _minute_files(src, minutes)
        summary = summarize_stream(stream_reviews(spark, src, max_files_per_trigger=1), 60, delay=60)
        q = start_summary_stream(summary, out, ckpt, files_per_batch=1, retention=retention)
        q.awaitTermination()
        assert q.exception() is None
        return summary.schema

    schema = drain(range(14))
    stored = read_summary(spark, out, schema)
    assert stored.select("window_start").distinct().count() == 12  # two are open
    history = History(spark, f"{scratch}/history", schema)
    history.compact(stored)
    time.sleep(20)
    drain(range(14, 20), "20 seconds")
    stored = read_summary(spark, out, schema)
    assert stored.select("window_start").distinct().count() < 18
    got = _rows(history.read(stored))
    assert len(got) == 36 and sum(r.reviews for r in history.read(stored).collect()) == 54
    files = len(glob.glob(f"{out}/*.parquet"))
    assert history.clear_sink(out, 15.0) > 0 and len(glob.glob(f"{out}/*.parquet")) < files
    again = History(spark, f"{scratch}/history", schema)
    assert _rows(again.read(read_summary(spark, out, schema))) == got
    again.compact(stored)
    assert _rows(again.read()) == got


def test_program_with_history(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    args = ["stream", src, work, out, "--interval", "60", "--time-col", "ts", "--delay", "1", "--files-per-trigger", "8", "--compact"]
    args += ["--retention", "3 minutes", "--keep", "1 day"]
    for part in range(2):
        _minute_files(src, range(part * 10, part * 10 + 10))
        run(spark, args)
        assert len(_window_folders(out)) == part * 10 + 10
    got = spark.read.json(out)
    assert got.count() == 20 and {r.reviews for r in got.select("reviews").collect()} == {2}
    kept = spark.read.option("basePath", f"{work}/history/data").parquet(*glob.glob(f"{work}/history/data/run=*"))
    assert kept.select("window_start").distinct().count() == 18
    with pytest.raises(ValueError, match="--compact"):
        run(spark, [*args[:-5], "--keep", "1 day"])
    with pytest.raises(ValueError, match="--keep must"):
        run(spark, [*args[:-1], "1 minute"])
