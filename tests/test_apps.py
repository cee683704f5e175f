"""The command-line programs on the FIXTURES cases."""

from __future__ import annotations

import json
import os
import threading
import time

import pytest

from plaudit.apps import run
from tests.test_streaming import _s1_files


def test_batch_program(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.json"), "w") as fh:
        for cat, label, pts in [("Donuts", "positive", 9)] * 15 + [("Donuts", "positive", 2)] + [("Bagels", "positive", 1)] * 4:
            fh.write(f'{{"cuisine": "{cat}", "evaluation": "{label}", "points": {pts}}}\n')
    out = os.path.join(scratch, "out")
    run(spark, ["batch", src, out, "--max-pct", "10"])
    rows = spark.read.json(out).collect()
    assert [(r.category, r.reviews, r.points, r.avg_points, r["rank"]) for r in rows] == [
        ("Donuts", 16, 137, 8.5625, 1)
    ]


def test_windowed_program_writes_a_folder_per_window(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    run(spark, ["windowed", src, work, out, "--interval", "60", "--window", "4", "--slide", "4", "--max-pct", "50"])
    folders = sorted(d for d in os.listdir(out) if d.startswith("window_start="))
    assert len(folders) == 3
    got = sorted((r.category, r.reviews, r.negatives) for r in spark.read.json(out).collect())
    assert got == [("a", 13, 4), ("a", 26, 8), ("a", 42, 12)]


def test_stream_program_scores_each_interval(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    run(spark, ["stream", src, work, out, "--interval", "60", "--max-pct", "50"])
    got = sorted(r.reviews for r in spark.read.json(out).collect())
    assert got == [5, 6, 7, 8, 9, 10, 11, 12, 13]


def test_lenient_batch_writes_rejects_only_when_there_are_some(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    good = [("Donuts", "positive", 9)] * 15 + [("Donuts", "positive", 2)] + [("Bagels", "positive", 1)] * 4
    with open(os.path.join(src, "part-0.json"), "w") as fh:
        for cat, label, pts in good:
            fh.write(f'{{"cuisine": "{cat}", "evaluation": "{label}", "points": {pts}}}\n')
    clean_out = os.path.join(scratch, "clean")
    run(spark, ["batch", src, clean_out, "--lenient"])
    assert not os.path.exists(os.path.join(clean_out, "_rejects"))
    with open(os.path.join(src, "part-1.json"), "w") as fh:
        fh.write("{broken\n")
    out = os.path.join(scratch, "out")
    run(spark, ["batch", src, out, "--lenient"])
    (reject,) = spark.read.json(os.path.join(out, "_rejects")).collect()
    assert reject.reason == "malformed" and reject.line == "{broken" and reject.file.endswith("/in/part-1.json")
    assert [r.category for r in spark.read.json(out).collect()] == ["Donuts"]


def test_windowed_program_with_pane_state(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    run(spark, ["windowed", src, work, out, "--interval", "60", "--window", "4", "--slide", "2",
                "--max-pct", "50", "--panes"])
    got = sorted((r.category, r.reviews, r.negatives) for r in spark.read.json(out).collect())
    assert got == [("a", 11, 4), ("a", 13, 4), ("a", 26, 8), ("a", 34, 10), ("a", 36, 10), ("a", 42, 12)]


def _lines(folder, rows, name="part-0.json"):
    with open(os.path.join(folder, name), "w") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in rows)


def _review(cat, label="positive", points=1, **more):
    return {"cuisine": cat, "evaluation": label, "points": points} | more


def test_four_intervals_give_four_folders(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _lines(src, [_review(c, created=f"2024-01-01T00:0{m}:30Z") for m in range(4) for c in "aab"])
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    run(spark, ["stream", src, work, out, "--interval", "60", "--time-col", "created"])
    assert len([d for d in os.listdir(out) if d.startswith("window_start=")]) == 4


def test_a_full_report_clears_the_target(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    out = os.path.join(scratch, "out")
    args = ["--interval", "60", "--window", "4", "--slide", "4"]
    run(spark, ["windowed", src, os.path.join(scratch, "w1"), out, *args, "--max-pct", "50"])
    run(spark, ["windowed", src, os.path.join(scratch, "w2"), out, *args, "--max-pct", "30"])
    kept = {r.reviews for r in spark.read.json(out).collect()}
    assert len([d for d in os.listdir(out) if d.startswith("window_start=")]) == len(kept) < 3


def test_start_offset_and_lenient_stream(spark, scratch, capsys):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    rows = [_review(c, ts=f"2024-01-01T00:0{m}:30Z") for m in range(4) for c in "aab"]
    rows += [_review("a", ts="no time"), _review("a"), _review("a", points="7d", ts="2024-01-01T00:00:30Z")]
    _lines(src, rows)
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    run(spark, ["windowed", src, work, out, "--interval", "60", "--window", "2", "--slide", "2", "--time-col", "ts",
                "--start", "60", "--lenient"])
    got = sorted(r.reviews for r in spark.read.json(out).collect())
    assert got == [2, 2, 4]  # windows begin at odd minutes
    rejects = spark.read.json(os.path.join(work, "rejects"))
    assert sorted(r.reason for r in rejects.collect()) == ["bad points", "bad time", "bad time"]
    assert all(r.file.endswith("/in/part-0.json") and r.block_start == 0 and r.modified for r in rejects.collect())
    with pytest.raises(Exception):
        run(spark, ["windowed", src, work + "2", out + "2", "--interval", "60", "--time-col", "ts"])


def test_late_rows_fail_a_strict_run_and_are_printed(spark, scratch, capsys):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for i in range(5):
        _lines(src, [_review("a", ts=f"2024-01-01T0{9 - i}:00:00Z")], f"f{i}.json")
        os.utime(os.path.join(src, f"f{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    args = ["--interval", "60", "--time-col", "ts", "--files-per-trigger", "1", "--delay", "0"]
    with pytest.raises(RuntimeError, match="late rows"):
        run(spark, ["stream", src, os.path.join(scratch, "w1"), os.path.join(scratch, "o1"), *args])
    run(spark, ["stream", src, os.path.join(scratch, "w2"), os.path.join(scratch, "o2"), *args, "--lenient"])
    assert "were dropped" in capsys.readouterr().out


@pytest.mark.parametrize("panes", [[], ["--panes"]])
def test_live_run_writes_while_it_runs(spark, scratch, panes):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _s1_files(src)
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    os.makedirs(os.path.join(out, "window_start=old"))
    seen, ended = [], threading.Event()

    def watch():
        while not ended.is_set():
            seen.append(len([d for d in os.listdir(out) if d.startswith("window_start=2")]) if os.path.isdir(out) else 0)
            time.sleep(0.2)

    watcher = threading.Thread(target=watch)
    watcher.start()
    slide = ["--window", "2", "--slide", "1"]
    try:
        run(spark, ["windowed", src, work, out, "--interval", "2", "--run-seconds", "40", "--delay", "0", *slide,
                    "--files-per-trigger", "1", "--max-pct", "50", *panes])
    finally:
        ended.set()
        watcher.join()
    assert len({n for n in seen if n}) > 1  # folders came one report after the other
    assert "window_start=old" not in os.listdir(out)  # the first report cleared the target
    got = [r.reviews for r in spark.read.json(out).collect()]
    assert len(got) == len(set(os.listdir(out)) - {"_SUCCESS"} - {d for d in os.listdir(out) if d.startswith(".")})
    # 2-second windows: each file alone, in two windows; the clock closed the last ones
    assert sorted(got) == [n for i in range(5, 14) for n in (i, i)]


def _window_folders(out):
    return sorted(d for d in os.listdir(out) if d.startswith("window_start=")) if os.path.isdir(out) else []


def _minute_files(folder, minutes, label="m"):
    """One file of one review for each minute of event time, in order of arrival."""
    for m in minutes:
        name = f"{label}{m:03d}.json"
        _lines(folder, [_review("a", ts=f"2024-01-01T{m // 60:02d}:{m % 60:02d}:30Z")] * 2 + [_review("b", ts=f"2024-01-01T{m // 60:02d}:{m % 60:02d}:30Z")], name)
        os.utime(os.path.join(folder, name), (1_700_000_000 + m, 1_700_000_000 + m))


@pytest.mark.parametrize("retention", [[], ["--retention", "4 minutes"]])
def test_a_restart_keeps_what_was_published(spark, scratch, retention):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    args = ["stream", src, work, out, "--interval", "60", "--time-col", "ts", "--delay", "1", "--files-per-trigger", "8", *retention]
    _minute_files(src, range(20))
    run(spark, args)
    first = _window_folders(out)
    assert len(first) == 20
    stamp = {d: os.path.getmtime(os.path.join(out, d)) for d in first}
    files = {d: sorted(os.listdir(os.path.join(out, d))) for d in first}
    _minute_files(src, range(20, 40))
    run(spark, args)
    assert len(_window_folders(out)) == 40
    # Windows that the first report had closed were not written again.
    again = [d for d in first if sorted(os.listdir(os.path.join(out, d))) != files[d]]
    assert len(again) <= 3 and set(again) <= set(first[-3:]), (again, stamp)
    got = spark.read.json(out)
    assert got.count() == 40 and {r.reviews for r in got.select("reviews").collect()} == {2}
    run(spark, args)  # nothing new
    assert len(_window_folders(out)) == 40


def test_a_report_cut_off_is_written_again(spark, scratch, monkeypatch):
    from plaudit.streaming.reports import ReportLog

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    args = ["stream", src, work, out, "--interval", "60", "--time-col", "ts", "--delay", "1"]
    _minute_files(src, range(5))
    run(spark, args)
    _minute_files(src, range(5, 10))
    with monkeypatch.context() as m:
        m.setattr(ReportLog, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError, match="driver lost"):
            run(spark, args)
    _minute_files(src, range(10, 12))
    run(spark, args)
    got = spark.read.json(out)
    assert got.count() == 12 and {r.reviews for r in got.select("reviews").collect()} == {2}


def test_retention_must_outlast_a_window(spark, scratch):
    with pytest.raises(ValueError, match="retention"):
        run(spark, ["windowed", scratch, scratch, scratch, "--interval", "60", "--retention", "4 minutes"])


def test_a_quiet_folder_closes_its_last_window(spark, scratch):
    """Files stop; the window they are in appears, live, within two intervals of its end."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    interval, seen, ended = 6, {}, threading.Event()

    def feed():
        for i in range(4):
            _lines(src, [_review("a")] * 3 + [_review("b")], f"f{i}.json")
            time.sleep(3)
        while not ended.is_set():
            for d in _window_folders(out):
                seen.setdefault(d, time.time())
            time.sleep(0.1)

    feeder = threading.Thread(target=feed)
    feeder.start()
    try:
        run(spark, ["stream", src, work, out, "--interval", str(interval), "--run-seconds", "48"])
    finally:
        ended.set()
        feeder.join()
    got = spark.read.json(out).collect()
    assert sum(r.reviews for r in got) == 12  # no review of "a" is missing or counted twice
    last = max(os.path.getmtime(os.path.join(src, f)) for f in os.listdir(src))
    end = (last // interval + 1) * interval
    assert max(seen.values()) - end <= 2 * interval + 2, (seen, end)
    # No windows, no ticks: they do not go on for ever.
    assert spark.read.parquet(os.path.join(work, "ticks")).count() <= 12


def test_another_window_on_the_same_work_folder_fails(spark, scratch):
    from plaudit.streaming import ManifestMismatch

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _minute_files(src, range(4))
    work, out = os.path.join(scratch, "work"), os.path.join(scratch, "out")
    args = ["windowed", src, work, out, "--interval", "60", "--time-col", "ts", "--slide", "2"]
    run(spark, [*args, "--window", "2"])
    before = _window_folders(out)
    for other, named in (
        (["--window", "4"], "window: '120' there, '240' now"), (["--window", "2", "--start", "30"], "start: '0' there"),
        (["--window", "4", "--panes", "--lenient"], "panes"),
    ):
        with pytest.raises(ManifestMismatch, match=named):
            run(spark, [*args, *other])
    assert _window_folders(out) == before
    assert not os.path.exists(os.path.join(work, "rejects"))  # nothing was started
    _minute_files(src, range(4, 6))
    run(spark, [*args, "--window", "2", "--delay", "3"])  # the horizon may change
    assert len(_window_folders(out)) == 3
