"""Command-line runs of the three programs a user of the original ran.

    python -m plaudit.apps batch    SRC OUT [--max-pct 10] [--order-by points]
    python -m plaudit.apps stream   SRC WORK OUT --interval 6 [--run-seconds 120]
    python -m plaudit.apps windowed SRC WORK OUT --interval 10 --window 4 --slide 4

``batch`` scores a folder of JSON-lines reviews once. ``stream`` scores every
micro-batch interval of arriving files on its own; ``windowed`` scores windows
of ``--window`` intervals every ``--slide`` intervals. Both streams use the
files' arrival (modification) time unless ``--time-col`` names an event time,
keep their state and progress under ``WORK`` (restartable), and write one
folder per batch / window under ``OUT``. The first report of a fresh ``WORK`` clears
``OUT``; a restart goes on from the log of reports in ``WORK``: it scores only windows
that no report holds, and keeps the folders of the others.

With ``--run-seconds`` the stream runs live: windows are scored and written as soon as they
have closed; those of arrival time also close when no file comes any more
(``streaming/clock.py``). Without it the input is drained and the windows still open
are scored too. Rows later than the horizon (``--delay``) are counted over all runs
on ``WORK`` and printed; without ``--lenient`` they fail the run.
"""

from __future__ import annotations

import argparse
import datetime
import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plaudit.operators.scorecard import scorecard
from plaudit.operators.windows import WINDOW_COLUMNS, pane_seconds, parse_seconds
from plaudit.session import session_conf
from plaudit.sinks.writers import write_scorecard
from plaudit.sources.json_reviews import read_reviews
from plaudit.streaming.clock import IDLE_CONF, ArrivalClock
from plaudit.streaming.history import History
from plaudit.streaming.ledger import BatchLedger
from plaudit.streaming.recover import manifest_of, start_or_recover
from plaudit.streaming.reports import ReportLog
from plaudit.streaming.windowed import (
    ARRIVAL,
    HORIZON,
    open_summary,
    read_summary,
    score_closed_windows,
    start_summary_stream,
    stream_reviews,
    summarize_stream,
)


def _common(p: argparse.ArgumentParser) -> None:
    p.add_argument("--max-pct", type=float, default=10.0, help="negative share allowed, percent")
    p.add_argument("--volume-rule", choices=("gt", "ge"), default="gt")
    p.add_argument("--fmt", choices=("json", "parquet", "csv"), default="json")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m plaudit.apps")
    sub = p.add_subparsers(dest="command", required=True)

    b = sub.add_parser("batch", help="score a folder of JSON-lines reviews")
    b.add_argument("source")
    b.add_argument("output")
    b.add_argument("--order-by", choices=("points", "avg_points"), default="points")
    b.add_argument("--lenient", action="store_true", help="score the good lines, bad ones to OUTPUT/_rejects")
    _common(b)

    for name, help_text in (
        ("stream", "score each micro-batch interval of arriving files"),
        ("windowed", "score windows of several intervals of arriving files"),
    ):
        s = sub.add_parser(name, help=help_text)
        s.add_argument("source")
        s.add_argument("work", help="shared folder for the stage-1 table and checkpoint")
        s.add_argument("output")
        s.add_argument("--interval", type=int, required=True, help="batch interval, seconds")
        s.add_argument("--order-by", choices=("points", "avg_points"), default="avg_points")
        s.add_argument(
            "--delay", type=int, default=None,
            help=f"how late a row may be, intervals (default: {HORIZON}; 1 for a live run by arrival)",
        )
        s.add_argument("--time-col", default=ARRIVAL, help="event-time column, or 'arrival'")
        s.add_argument("--start", type=int, default=0, help="offset of the windows, seconds")
        s.add_argument("--lenient", action="store_true", help="bad lines to OUTPUT/_rejects; late rows only counted")
        s.add_argument("--files-per-trigger", type=int, default=None)
        s.add_argument("--bytes-per-trigger", type=int, default=256 << 30, help="bytes of a micro-batch, unless files are given")
        s.add_argument("--files-per-batch", type=int, default=None, help="files a closing batch writes")
        s.add_argument(
            "--retention", default=None,
            help="age of files in the summaries' file list, e.g. '7 days'; longer than a window with its delay",
        )
        s.add_argument(
            "--compact", action="store_true",
            help="keep the closed windows' summaries in few files below WORK/history, whatever --retention drops",
        )
        s.add_argument("--keep", default=None, help="with --compact: age of a day's summaries that may go, e.g. '90 days'")
        s.add_argument("--large-state", action="store_true", help="RocksDB state store (many keys)")
        s.add_argument(
            "--run-seconds", type=float, default=None,
            help="run live this long (trigger every interval); default: drain what is there",
        )
        if name == "windowed":
            s.add_argument("--window", type=int, default=4, help="window length, intervals")
            s.add_argument("--slide", type=int, default=4, help="slide, intervals")
            s.add_argument(
                "--panes", action="store_true",
                help="keep state per pane, not per sliding window (late rows: see README)",
            )
        _common(s)
    return p


def run(spark: SparkSession, args: Sequence[str]) -> None:
    opts = parser().parse_args(list(args))
    if opts.command == "batch":
        rejected = Observation() if opts.lenient else None
        if opts.lenient:
            reviews, rejects = read_reviews(spark, opts.source, "lenient", rejected=rejected)
        else:
            reviews = read_reviews(spark, opts.source, "strict")
        card = scorecard(reviews, max_pct_negative=opts.max_pct, volume_rule=opts.volume_rule, order_by=opts.order_by)
        write_scorecard(card, opts.output, fmt=opts.fmt)
        # The scoring pass counted the bad rows; read the input again only
        # to write them out when there are any.
        if rejected is not None and rejected.get["rejected"] > 0:
            rejects.write.mode("overwrite").json(f"{opts.output.rstrip('/')}/_rejects")
        return

    window = opts.interval * (opts.window if opts.command == "windowed" else 1)
    slide = opts.interval * (opts.slide if opts.command == "windowed" else 1)
    panes = getattr(opts, "panes", False) and slide < window
    length = pane_seconds(window, slide) if panes else window
    is_live, by_arrival = opts.run_seconds is not None, opts.time_col == ARRIVAL
    if opts.delay is None:
        opts.delay = 1 if is_live and by_arrival else HORIZON
    delay = opts.delay * opts.interval
    if opts.retention and parse_seconds(opts.retention) <= window + delay:
        raise ValueError(f"--retention must be longer than a window with its delay, {window + delay} seconds")
    if opts.keep and not opts.compact:
        raise ValueError("--keep needs --compact")
    if opts.keep and parse_seconds(opts.keep) <= window + delay:
        raise ValueError(f"--keep must be longer than a window with its delay, {window + delay} seconds")
    bounds = {} if opts.files_per_trigger else {"maxBytesPerTrigger": str(opts.bytes_per_trigger)}
    reviews = stream_reviews(
        spark, opts.source, time=opts.time_col, max_files_per_trigger=opts.files_per_trigger,
        mode="lenient" if opts.lenient else "strict", options=bounds,
    )
    work, queries = opts.work.rstrip("/"), []
    # By arrival the clock closes windows: more triggers than intervals, so that this takes
    # less than one.
    trigger = max(1.0, opts.interval / 4) if by_arrival else float(opts.interval)
    live = f"{int(trigger * 1000)} milliseconds" if is_live else None
    if opts.lenient:
        reviews, rejects = reviews
    clock = ArrivalClock(spark, f"{work}/ticks") if by_arrival else None
    summary = summarize_stream(
        reviews, length, length if panes else slide, delay, start=opts.start, ticks=clock.ticks() if clock else None
    )
    ledger = BatchLedger(spark, f"{work}/ledger")
    manifest = manifest_of(
        summary, source=opts.source.rstrip("/"), time=opts.time_col, window=window, slide=slide, panes=panes,
        start=opts.start % slide, horizon=delay,
    )
    history = None
    if opts.compact:
        history = Compaction(spark, opts, work, summary.schema)
        # What an earlier run left, before this one's sink may drop it from its list.
        history.run(force=True)
    with session_conf(spark, IDLE_CONF):
        query = start_or_recover(
            spark, f"plaudit {work}", f"{work}/manifest", manifest,
            lambda name: start_summary_stream(
                summary, f"{work}/summaries", f"{work}/checkpoint", live is None, live, name,
                files_per_batch=opts.files_per_batch, retention=opts.retention,
            ),
        )
    if opts.lenient:
        queries.append(
            start_summary_stream(
                rejects, f"{work}/rejects", f"{work}/checkpoint-rejects", live is None, live, fmt="json"
            )
        )
    report = Report(spark, opts, work, summary.schema, (window, slide, opts.start) if panes else None, history)
    if live is None:
        while not ledger.follow(query, history.every if history else None):
            history.run()
        for q in queries:
            q.awaitTermination()
        for q in [query, *queries]:
            _raise_for(q)
        still_open = None
        if query.lastProgress is not None:
            still_open = open_summary(spark, f"{work}/checkpoint", summary.schema, length)
        report.write(query, still_open)
    else:
        end = time.monotonic() + opts.run_seconds
        while (left := end - time.monotonic()) > 0:
            if ledger.follow(query, min(trigger, left)):
                break
            if clock is not None:
                clock.advance(query)
            if history is not None:
                history.run()
            report.write(query)
        for q in [query, *queries]:
            q.stop()
            _raise_for(q)
        ledger.poll(query)
        ledger.flush()
        report.write(query)
    if history is not None:
        history.run(force=True)
    found = ledger.account()
    if found.rows_dropped:
        print(f"{found.rows_dropped} rows came later than {opts.delay} intervals and were dropped")
    if not opts.lenient:
        found.check(f"{opts.delay} intervals (--delay; --lenient only counts them)")


def _raise_for(query: StreamingQuery) -> None:
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.name or query.id} failed: {query.exception()}")


class Compaction:
    """Moves closed windows of the summaries to ``WORK/history``, often enough that ``--retention`` drops
    none before, and lets days go that lie ``--keep`` before the latest published window."""

    def __init__(self, spark, opts, work: str, schema):
        self.spark, self.path, self.schema = spark, f"{work}/summaries", schema
        self.table = History(spark, f"{work}/history", schema)
        self.retention = parse_seconds(opts.retention) if opts.retention else None
        self.keep = parse_seconds(opts.keep) if opts.keep else None
        self.every = min(60.0, self.retention / 4) if self.retention else 60.0
        self.last = None

    def run(self, force: bool = False) -> None:
        if not force and self.last is not None and time.monotonic() - self.last < self.every:
            return
        self.last = time.monotonic()
        try:
            stored = read_summary(self.spark, self.path, self.schema)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return  # no batch has run, there is no table
        self.table.compact(stored)
        if self.retention is not None:
            self.table.clear_sink(self.path, 2 * self.retention)

    def expire(self, published: datetime.datetime | None) -> None:
        """Counted from the latest published window: one that no report holds doesn't expire."""
        if self.keep is not None and published is not None:
            self.table.expire(published - datetime.timedelta(seconds=self.keep))


class Report:
    """Scores and writes the windows closed since the last report, of this run or an earlier one.

    The first one on a fresh ``WORK`` covers all stored windows and replaces the output;
    windows that close later end after all of them, so the following ones add folders
    only. Open windows of a drained run are written as they stand, and again when they close.
    """

    def __init__(self, spark, opts, work: str, schema, panes, history: Compaction | None = None):
        self.history = history
        self.spark, self.opts, self.path, self.schema, self.panes = spark, opts, f"{work}/summaries", schema, panes
        self.log = ReportLog(spark, f"{work}/reports")
        self.batch = None

    def write(self, query: StreamingQuery, open_rows: DataFrame | None = None) -> None:
        last = query.lastProgress
        if last is None:  # no batch has run, there is no table
            return
        if open_rows is None and last["batchId"] == self.batch and not self.log.empty:
            return  # nothing has run since
        stored = read_summary(self.spark, self.path, self.schema)
        if self.history is not None:
            stored = self.history.table.read(stored)
        # Up to here windows are closed: with panes by the batch's watermark,
        # otherwise the stored ones are.
        watermark = last["eventTime"].get("watermark") if self.panes else None
        if watermark is not None:
            limit = int(datetime.datetime.fromisoformat(watermark).timestamp()) * 1_000_000
        else:
            limit = stored.agg(F.unix_micros(F.max("window_end"))).first()[0]
        self.batch = last["batchId"]
        if open_rows is None and not self.log.empty and limit in (None, self.log.until_micros):
            return
        opts = self.opts
        card = score_closed_windows(
            self.spark, self.path, opts.max_pct, opts.volume_rule, opts.order_by, self.schema, since=self.log.until,
            panes=self.panes, closed_until=watermark, open_rows=open_rows, summary=stored,
        )
        write_scorecard(
            card, opts.output, fmt=opts.fmt, scope=list(WINDOW_COLUMNS), partition_by_scope=True,
            incremental=not self.log.empty,
        )
        self.log.commit(limit, last["batchId"])
        if self.history is not None:
            self.history.expire(self.log.until)


def main(argv: Sequence[str] | None = None) -> None:
    import sys

    from plaudit.session import build_session, checkpoint_dir

    args = sys.argv[1:] if argv is None else list(argv)
    spark = build_session(large_state="--large-state" in args)
    checkpoint_dir(spark)  # a shared checkpoint folder must be configured
    run(spark, args)


if __name__ == "__main__":
    main()
