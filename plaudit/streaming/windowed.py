"""STR1-STR10: scorecards over arriving files, per batch or per time window.

Structured Streaming rejects the two things a scorecard needs after its
aggregate — a per-window total attached to each row (non-time window
functions) and a sort — and a per-window ``collect_list`` would put all
categories of a window into one row of one task. So the stream is split at
the one point where its output is complete:

* **stage 1** (streaming, stateful): reviews → ``withWatermark`` →
  ``groupBy(window, category)`` partial/final aggregate, append mode. State
  is one row per (window, category), spread over the state store partitions
  by key. A window's rows are emitted once, all in the micro-batch in which
  the watermark passes the window's end, and the file sink commits each
  micro-batch atomically (``_spark_metadata``), so the stage-1 table only
  ever holds whole, closed windows — exactly once across restarts through the
  checkpoint.
* **stage 2** (batch): ``score_summary`` with ``scope = window`` over the
  stage-1 table: the same distributed plan as any batch scorecard.

A drained backfill has no later rows, so its open windows are final too: their
rows are read from the state store and scored with the stored ones.

Rows later than the watermark's horizon are dropped by Spark; they are counted batch by
batch (``ledger.py``) and fail a strict backfill. Rows without a time fail.

Time is the review's event time, or its arrival time taken as the source
file's modification time (``_metadata.file_modification_time``), which is
replayable where wall-clock arrival is not.
"""

from __future__ import annotations

import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plaudit.functions.time import instant_to_ntz, ntz_to_instant
from plaudit.operators.scorecard import score_summary
from plaudit.operators.summarize import summarize
from plaudit.operators.windows import WINDOW_COLUMNS, pane_seconds, parse_seconds, windows_from_panes
from plaudit.schema import REVIEW_JSON_SCHEMA
from plaudit.sources.json_reviews import (
    CORRUPT,
    split_lenient,
    strict_rows,
    times_as_text,
    with_corrupt_column,
    with_origin,
)
from plaudit.streaming.ledger import BatchLedger

ARRIVAL = "arrival"
# How many intervals a row may be late by default.
HORIZON = 17
LATE = ("fail", "count")
# Before any time of a review: the first microsecond of the year 1.
NEVER = -62_135_596_800_000_000


def stream_reviews(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REVIEW_JSON_SCHEMA,
    time: str = "ts",
    max_files_per_trigger: int | None = None,
    mode: str = "strict",
    options: dict[str, str] | None = None,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """SRC3: a stream of JSON-lines reviews from new files in ``path``.

    ``time="arrival"`` stamps each review with its file's modification time
    (the reference's notion of a batch); otherwise ``time`` names the event
    time column. ``strict``: a bad line fails the query. ``lenient``: returns
    ``(reviews, rejects)``; start a query on each (every query reads the new
    files itself). ``options`` go to the file source as they are, e.g.
    ``{"cleanSource": "archive", "sourceArchiveDir": …}``, ``maxFileAge`` to
    keep a long-running source's file log bounded, or ``maxBytesPerTrigger``.
    An event-time column that ``schema`` lacks is added to it as text and read
    like ``ts``; a review without a readable event time fails or is rejected.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError(f"mode must be 'strict' or 'lenient', got {mode!r}")
    if time not in (ARRIVAL, *schema.names):
        schema = T.StructType([*schema.fields, T.StructField(time, T.StringType(), True)])
    schema = times_as_text(schema, time)
    reader = spark.readStream
    if mode == "strict":
        reader = reader.schema(schema).option("mode", "FAILFAST")
    else:
        reader = (
            reader.schema(with_corrupt_column(schema))
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
        )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    raw = reader.json(path)
    if mode == "lenient":
        raw = with_origin(raw)
    if time == ARRIVAL:
        raw = raw.withColumn("ts", F.col("_metadata.file_modification_time"))
    elif time != "ts":
        raw = raw.drop("ts").withColumn("ts", F.col(time))
    needs_time = time != ARRIVAL
    return strict_rows(raw, needs_time) if mode == "strict" else split_lenient(raw, needs_time=needs_time)


def summarize_stream(
    reviews: DataFrame,
    duration: int | str,
    slide: int | str | None = None,
    delay: int | str | None = None,
    time_col: str = "ts",
    start: int | str = 0,
    ticks: DataFrame | None = None,
) -> DataFrame:
    """Stage 1: per-(window, category) measures of a review stream, append mode.

    ``delay`` is how late a row may be; ``HORIZON`` slides by default. ``ticks``
    (``ArrivalClock.ticks``) move the watermark as well and count nowhere.

    TIMESTAMP_NTZ times are read as UTC wall clock (``withWatermark`` needs
    TIMESTAMP) and the window bounds are given back as TIMESTAMP_NTZ.
    ``slide > duration`` keeps the first ``duration`` of every
    ``slide`` (sampling windows).
    """
    timed, w, ntz = windowed_reviews(reviews, duration, slide, delay, time_col, start, ticks)
    return window_rows(summarize(timed, scope=["_window"]), w, ntz)


def windowed_reviews(
    reviews: DataFrame,
    duration: int | str,
    slide: int | str | None = None,
    delay: int | str | None = None,
    time_col: str = "ts",
    start: int | str = 0,
    ticks: DataFrame | None = None,
) -> tuple[DataFrame, int, bool]:
    """The reviews with their ``_window`` and a watermark, the window's length in seconds
    and whether their time is TIMESTAMP_NTZ."""
    w = parse_seconds(duration)
    s = parse_seconds(slide) if slide is not None else w
    d = parse_seconds(delay) if delay is not None else HORIZON * s
    offset = f"{parse_seconds(start) % s} seconds"  # F.window wants it below the slide
    ntz = isinstance(reviews.schema[time_col].dataType, T.TimestampNTZType)
    t = ntz_to_instant(F.col(time_col)) if ntz else F.col(time_col)
    t = F.when(t.isNull(), F.raise_error(F.lit("review without a time"))).otherwise(t)
    timed = reviews.withColumn("_t", t)
    if ticks is None:
        timed = timed.withWatermark("_t", f"{d} seconds")
    else:
        tick = ticks.select(F.col("ts").alias("_t"), F.lit(True).alias("_tick"))
        both = timed.withColumn("_tick", F.lit(False)).unionByName(tick, allowMissingColumns=True)
        # The condition reads the time, too: otherwise it would be moved below the
        # watermark and the ticks would not reach it.
        counts = ~F.col("_tick") | (F.col("_t") < F.timestamp_micros(F.lit(NEVER)))
        timed = both.withWatermark("_t", f"{d} seconds").where(counts)
    if s <= w:
        timed = timed.withColumn("_window", F.window("_t", f"{w} seconds", f"{s} seconds", offset))
    else:
        timed = timed.withColumn("_window", F.window("_t", f"{s} seconds", startTime=offset)).where(
            F.col("_t") < F.col("_window.start") + F.expr(f"INTERVAL {w} SECONDS")
        )
    return timed, w, ntz


def window_rows(grouped: DataFrame, w: int, ntz: bool, *more: str) -> DataFrame:
    """Grouped rows with the bounds of their ``_window`` and the columns ``more``."""
    begin = F.col("_window.start")
    end = begin + F.expr(f"INTERVAL {w} SECONDS")
    if ntz:
        begin, end = instant_to_ntz(begin), instant_to_ntz(end)
    return grouped.select(
        begin.alias("window_start"),
        end.alias("window_end"),
        "category",
        "reviews",
        "negatives",
        "points",
        *more,
    )


def open_summary(spark: SparkSession, checkpoint_path: str, schema: T.StructType, duration: int | str) -> DataFrame:
    """The rows of windows that the last committed batch left open, from the
    state store; ``schema`` and ``duration`` are stage 1's.

    Windows in the state are not in the stage-1 table and the other way round.
    Before the first batch there are none.
    """
    ntz = isinstance(schema["window_start"].dataType, T.TimestampNTZType)
    try:
        state = spark.read.format("statestore").load(checkpoint_path)
    except PySparkException as e:
        if e.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise
        return spark.createDataFrame([], schema)
    # The buffers of ``summarize``'s three aggregates, by position.
    measures = F.col("value").cast("struct<reviews:bigint,negatives:bigint,points:bigint>")
    rows = state.select("key.*", measures.alias("m")).select("_window", "category", "m.*")
    return window_rows(rows, parse_seconds(duration), ntz)


def late_rows(query: StreamingQuery, after_batch: int = -1) -> int:
    """Rows (summed per key and task) that the watermark has dropped in batches
    after ``after_batch``, as far back as the query keeps its progress; ``BatchLedger`` keeps
    the account of all."""
    return sum(
        op["numRowsDroppedByWatermark"]
        for p in query.recentProgress
        if p["batchId"] > after_batch
        for op in p["stateOperators"]
    )


def start_summary_stream(
    summary_stream: DataFrame,
    output_path: str | None,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    retention: str | None = None,
) -> StreamingQuery:
    """STR1/STR7/SNK2: write stage 1 to files with a checkpoint.

    ``files_per_batch`` bounds the files a closing batch writes (one per state
    partition otherwise), ``retention`` (``"7 days"``) drops older files from
    the sink's file list.

    ``available_now`` drains what is there and stops (backfill, tests);
    ``processing_time`` (e.g. ``"6 seconds"``) runs live. Restarting on the
    same checkpoint resumes where it stopped and writes nothing twice.
    ``fmt="console"`` prints each micro-batch instead (SNK3; no path).
    """
    if files_per_batch:
        summary_stream = summary_stream.coalesce(files_per_batch)
    writer = (
        summary_stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
    )
    if output_path is not None:
        writer = writer.option("path", output_path)
    if retention:
        writer = writer.option("retention", f"{parse_seconds(retention)}s")
    if query_name:
        writer = writer.queryName(query_name)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _not_after(column: str, df: DataFrame, instant: str) -> Column:
    """``column <= instant`` for an ISO-8601 UTC instant (``…Z``), for
    TIMESTAMP and TIMESTAMP_NTZ columns alike, whatever the session zone."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        wall = instant.rstrip("Z").replace("T", " ")
        return F.col(column) <= F.lit(wall).cast("timestamp_ntz")
    return F.col(column) <= F.lit(instant).cast("timestamp")


def score_closed_windows(
    spark: SparkSession,
    summary_path: str,
    max_pct_negative: float = 10.0,
    volume_rule: str = "gt",
    order_by: str = "avg_points",
    schema: T.StructType | None = None,
    since: datetime.datetime | None = None,
    panes: tuple[int | str, int | str | None, int | str] | None = None,
    closed_until: str | None = None,
    open_rows: DataFrame | None = None,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Stage 2: the scorecard of every closed window written by stage 1.

    Pass the stage-1 ``schema`` so that a stream that has closed no window
    yet scores to an empty frame instead of failing schema inference.
    ``since`` scores only windows ending after it (an incremental report; the
    filter reaches the Parquet scan). Windows are whole, so this never splits
    one.

    ``panes=(duration, slide, start)`` reads a stage-1 table of panes (see
    ``windowed_scorecard(panes=True)``) and builds the windows from them; a
    window is closed when it ends at or before ``closed_until``, the stage-1
    query's last watermark (ISO-8601), else at or before the end of the
    latest pane written (every pane ending by then has been written).

    ``open_rows`` (``open_summary`` of a drained query) are scored too: all
    windows are final then. ``summary`` is the stage-1 table as one frame, read
    here if not given: its files are those committed when it was made, so all
    of a report comes from one state of the table.
    """
    if summary is None:
        summary = read_summary(spark, summary_path, schema)
    if open_rows is not None:
        summary = summary.unionByName(open_rows)
    if panes is not None:
        duration, slide, start = panes
        pane_rows = summary.select(
            F.col("window_start").alias("pane_start"), "category", "reviews", "negatives", "points"
        )
        latest = summary.agg(F.max("window_end").alias("_latest"))
        summary = windows_from_panes(pane_rows, duration, slide, start)
        if open_rows is not None:
            pass
        elif closed_until is not None:
            summary = summary.where(_not_after("window_end", summary, closed_until))
        else:
            summary = summary.where(F.col("window_end") <= latest.scalar())
    if since is not None:
        summary = summary.where(F.col("window_end") > F.lit(since))
    return score_summary(
        summary,
        scope=list(WINDOW_COLUMNS),
        max_pct_negative=max_pct_negative,
        volume_rule=volume_rule,
        order_by=order_by,
        materialize=False,
    )


def read_summary(spark: SparkSession, summary_path: str, schema: T.StructType | None = None) -> DataFrame:
    """The stage-1 table as committed now."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(summary_path)


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """STR8: wait up to ``seconds`` for a live query, then stop it.

    Returns whether it had finished by itself. ``stop`` interrupts a batch that is
    running; whatever was committed stays committed (checkpoint), and a later
    start on the same checkpoint runs that batch again and picks up the rest.
    """
    finished = query.awaitTermination(seconds)
    if not finished:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.name or query.id} failed: {query.exception()}")
    return bool(finished)


def windowed_scorecard(
    reviews: DataFrame,
    summary_path: str,
    checkpoint_path: str,
    duration: int | str,
    slide: int | str | None = None,
    delay: int | str | None = None,
    max_pct_negative: float = 10.0,
    volume_rule: str = "gt",
    order_by: str = "avg_points",
    time_col: str = "ts",
    panes: bool = False,
    start: int | str = 0,
    open_windows: bool = True,
    late: str = "count",
    ledger_path: str | None = None,
) -> DataFrame:
    """STR2/STR4 end to end for a backfill: drain the stream (availableNow)
    through stage 1, then return the stage-2 scorecard of its windows.

    ``open_windows=False`` scores only those the watermark has closed.
    ``late="fail"`` fails if the watermark dropped rows in any batch; ``ledger_path`` keeps
    the account of the batches (``BatchLedger``) for the next run on the checkpoint.

    ``panes=True`` (sliding windows): stage 1 keeps one state row per
    (pane, category) with panes of ``gcd(duration, slide)`` — ``duration /
    slide`` times less state and work per review than ``F.window`` — and
    stage 2 builds the windows. Same results for rows on time. Spark drops a
    late row from a state key that ended by its late-row watermark (that of
    the trigger before): with panes that is the row's pane, so every window
    loses it; with ``F.window`` only the windows that ended lose it and the
    open ones still count it.

    For a live run use ``summarize_stream`` + ``start_summary_stream`` with a
    ``processing_time`` trigger and call ``score_closed_windows`` per report.
    """
    if late not in LATE:
        raise ValueError(f"late must be one of {LATE}, got {late!r}")
    w = parse_seconds(duration)
    s = parse_seconds(slide) if slide is not None else w
    use_panes = panes and s < w
    length = pane_seconds(w, s) if use_panes else w
    if delay is None:
        delay = HORIZON * s
    summary = summarize_stream(reviews, length, length if use_panes else s, delay, time_col, start)
    ledger = BatchLedger(reviews.sparkSession, ledger_path)
    query = start_summary_stream(summary, summary_path, checkpoint_path)
    ledger.follow(query)
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    if late == "fail":
        ledger.account().check(f"{delay} seconds" if isinstance(delay, int) else delay)
    watermark, last = None, query.lastProgress
    if use_panes and last is not None:
        watermark = last.get("eventTime", {}).get("watermark")
    still_open = None
    if open_windows and last is not None:
        still_open = open_summary(reviews.sparkSession, checkpoint_path, summary.schema, length)
    return score_closed_windows(
        reviews.sparkSession,
        summary_path,
        max_pct_negative,
        volume_rule,
        order_by,
        summary.schema,
        panes=(w, s, start) if use_panes else None,
        closed_until=watermark,
        open_rows=still_open,
    )
