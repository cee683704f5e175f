"""Driver queries: one callable ``(spark, sf_dir) -> DataFrame`` per inventory item.

Every query reads whole driver tables (or data Spark derives from them) —
no id subsets, no row caps. A1 = ``events`` as reviews (category = user),
A2 = ``lineitem`` ⋈ ``part`` summarised per brand.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.functions.measures import lenient_points, negative_flag, signed_points
from plaudit.operators.filters import keep_liked, keep_popular
from plaudit.operators.scorecard import score_summary, scorecard, with_ratios
from plaudit.operators.summarize import summarize
from plaudit.operators.totals import scope_totals, with_scope_totals
from plaudit.operators.windows import WINDOW_COLUMNS, summarize_windows, with_day
from plaudit.session import LARGE_STATE_CONF, scratch_path, session_conf
from plaudit.sinks.writers import write_scorecard
from plaudit.sources.adapters import (
    brand_summary,
    event_evaluation,
    reviews_from_events,
    ship_month,
)
from plaudit.sources.json_reviews import parse_json_column, read_reviews
from plaudit.sources.tables import load_table, stream_table
from plaudit.streaming.clock import ArrivalClock
from plaudit.streaming.history import History
from plaudit.streaming.ledger import BatchLedger
from plaudit.streaming.maintained import read_maintained, update_summary
from plaudit.streaming.totals import scored_stream
from plaudit.streaming.windowed import (
    ARRIVAL,
    HORIZON,
    read_summary,
    start_summary_stream,
    stream_reviews,
    summarize_stream,
    windowed_scorecard,
)

# Parameters of the driver queries (shared with the SQL oracle).
EVENTS_MAX_PCT = 20.0  # A1: share of error events allowed, in percent
BRANDS_MAX_PCT = 34.0  # A2: share of returned items allowed, in percent
DAY_MAX_PCT = 10.0  # A1 per calendar day
WINDOW = 4 * 86400  # 4-day windows
SLIDE = 86400  # sliding every day
SAMPLE_EVERY = 2 * 86400  # sampling: the first day of every 2 days
SAMPLE_LENGTH = 86400
WINDOW_START = 86400 + 6 * 3600  # offset of the shifted windows
STREAM_HORIZON = HORIZON  # how many slides a streamed row may be late
STREAM_OPTIONS = {"maxBytesPerTrigger": str(256 << 30)}  # bytes of a stream batch
FINE_SLIDE = 6 * 3600  # sliding every 6 hours: 16 windows hold a review
CENTURY = 100 * 365 * 86400


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_from_events(load_table(spark, sf_dir, "events"))


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brand_summary(load_table(spark, sf_dir, "lineitem"), load_table(spark, sf_dir, "part"))


def _stored(summary: DataFrame) -> DataFrame:
    """A summary read by both the totals and the rows: checkpoint it so the
    input is scanned once (as ``score_summary`` does)."""
    return summary.checkpoint(eager=True)


# -- sources and projections ------------------------------------------------


def json_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2 + PRJ3: JSON text in ``events.props`` parsed, ``k`` cast leniently."""
    events = load_table(spark, sf_dir, "events").select("event_id", "props")
    parsed = parse_json_column(events, "props", "k STRING")
    return parsed.select("event_id", lenient_points(F.col("parsed.k")).alias("points"))


def review_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1-PRJ7 on every A1 review."""
    reviews = reviews_from_events(load_table(spark, sf_dir, "events"), with_id=True)
    return reviews.select(
        "event_id",
        "category",
        "evaluation",
        "points",
        negative_flag("evaluation").alias("negative"),
        signed_points("evaluation", "points").alias("signed_points"),
    )


# -- aggregates and totals --------------------------------------------------


def category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1."""
    return summarize(_events(spark, sf_dir))


def category_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2: number of categories (the null category counts)."""
    return scope_totals(summarize(_events(spark, sf_dir))).select(
        F.col("scope_categories").alias("categories")
    )


def review_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3/AGG4: total reviews as the sum of the group counts."""
    return scope_totals(summarize(_events(spark, sf_dir))).select(
        F.col("scope_reviews").alias("reviews")
    )


def average_reviews_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5 on A1."""
    return scope_totals(summarize(_events(spark, sf_dir)))


def average_reviews_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5 on A2."""
    return scope_totals(_brands(spark, sf_dir))


def totals_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON1/JON2: scope totals on every category row (whole data set)."""
    return with_scope_totals(_stored(summarize(_events(spark, sf_dir))))


def totals_attached_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON2 with a scope: per-day totals on every (day, category) row."""
    return with_scope_totals(_stored(summarize(with_day(_events(spark, sf_dir)), ["day"])), ["day"])


# -- filters and ratios -----------------------------------------------------


def popular_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT1 on A1."""
    scored = with_scope_totals(_stored(summarize(_events(spark, sf_dir))))
    return keep_popular(scored).select("category", "reviews", "avg_reviews")


def liked_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2 on A1."""
    scored = with_ratios(summarize(_events(spark, sf_dir)))
    return keep_liked(scored, EVENTS_MAX_PCT).select("category", "reviews", "negatives", "pct_negative")


def popular_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT1 on A2."""
    scored = with_scope_totals(_stored(_brands(spark, sf_dir)))
    return keep_popular(scored).select("category", "reviews", "avg_reviews")


def liked_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2 on A2."""
    scored = with_ratios(_brands(spark, sf_dir))
    return keep_liked(scored, BRANDS_MAX_PCT).select("category", "reviews", "negatives", "pct_negative")


def brand_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ8/PRJ9 on A2."""
    return with_ratios(_brands(spark, sf_dir))


# -- scorecards -------------------------------------------------------------


def scorecard_by_points_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 / SRT1 on A1: the batch program (``>`` average, sorted by points)."""
    return scorecard(_events(spark, sf_dir), max_pct_negative=EVENTS_MAX_PCT, order_by="points")


def scorecard_by_points_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 / SRT1 on A2."""
    return score_summary(_brands(spark, sf_dir), max_pct_negative=BRANDS_MAX_PCT, order_by="points")


def scorecard_by_avg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 on A1: ``>=`` average, sorted by average points."""
    return scorecard(_events(spark, sf_dir), max_pct_negative=EVENTS_MAX_PCT, volume_rule="ge")


def scorecard_by_avg_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 on A2."""
    return score_summary(_brands(spark, sf_dir), max_pct_negative=BRANDS_MAX_PCT, volume_rule="ge")


def scorecard_brands_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 per ship month: many scopes, totals joined per scope."""
    lineitem = load_table(spark, sf_dir, "lineitem")
    summary = brand_summary(lineitem, load_table(spark, sf_dir, "part"), {"month": ship_month(lineitem)})
    return score_summary(summary, scope=["month"], max_pct_negative=BRANDS_MAX_PCT)


def scorecard_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch twin of Q2: every calendar day scored on its own."""
    return scorecard(with_day(_events(spark, sf_dir)), scope=["day"], max_pct_negative=DAY_MAX_PCT)


def _windowed(spark: SparkSession, sf_dir: str, duration: int, slide: int) -> DataFrame:
    summary = summarize_windows(_events(spark, sf_dir), "ts", duration, slide)
    return score_summary(
        summary, scope=["window_start", "window_end"], max_pct_negative=EVENTS_MAX_PCT
    )


def scorecard_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch twin of Q3: 4-day tumbling windows."""
    return _windowed(spark, sf_dir, WINDOW, WINDOW)


def scorecard_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch twin of Q3: 4-day windows sliding by a day (from panes of a day)."""
    return _windowed(spark, sf_dir, WINDOW, SLIDE)


def scorecard_sliding_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3 with many slides: 4-day windows sliding by 6 hours, from running sums."""
    return _windowed(spark, sf_dir, WINDOW, FINE_SLIDE)


def scorecard_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3 with slide > length: the first day of every second day."""
    return _windowed(spark, sf_dir, SAMPLE_LENGTH, SAMPLE_EVERY)


# -- JSON round trips (SRC1, SRC2, SNK1) -------------------------------------


def _review_json(spark: SparkSession, sf_dir: str, points_as_text: bool) -> str:
    """Write A1 as JSON lines with the reference's keys; return the folder.

    With ``points_as_text`` the raw event value goes out as text (``"29.27"``),
    which only the lenient cast accepts (truncated to 29, as A1 does).
    """
    events = load_table(spark, sf_dir, "events")
    points = F.col("value").cast("string") if points_as_text else F.col("value").cast("bigint")
    path = scratch_path(spark, "reviews-json")
    events.select(
        F.col("user_id").cast("string").alias("cuisine"),
        event_evaluation(F.col("event_type")).alias("evaluation"),
        points.alias("points"),
    ).write.json(path)
    return path


def scorecard_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1/SRC2 strict: A1 written as JSON lines, read back, scored (Q1)."""
    path = _review_json(spark, sf_dir, points_as_text=False)
    return scorecard(read_reviews(spark, path, "strict"), max_pct_negative=EVENTS_MAX_PCT, order_by="points")


def scorecard_from_json_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1/SRC2 lenient: decimal points as text are truncated, not rejected."""
    path = _review_json(spark, sf_dir, points_as_text=True)
    reviews, _rejects = read_reviews(spark, path, "lenient")
    return scorecard(reviews, max_pct_negative=EVENTS_MAX_PCT, order_by="points")


# -- streams (STR1-STR10, SRC3, SNK2) ----------------------------------------


def _stream(
    spark: SparkSession,
    sf_dir: str,
    duration: int,
    slide: int,
    max_pct: float,
    panes: bool = False,
    start: int = 0,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """``events`` as a Structured Streaming source (availableNow) through
    stage 1, then the batch scorecard of all its windows.

    Batches are bounded in bytes and the state is kept in RocksDB, so a
    backfill of any size fits; a row later than the horizon fails the query.
    """
    events = stream_table(spark, sf_dir, "events", STREAM_OPTIONS | (options or {}))
    with session_conf(spark, LARGE_STATE_CONF):
        return windowed_scorecard(
            reviews_from_events(events),
            scratch_path(spark, "stream-out"),
            scratch_path(spark, "stream-checkpoint"),
            duration,
            slide,
            STREAM_HORIZON * slide,
            max_pct_negative=max_pct,
            panes=panes,
            start=start,
            late="fail",
        )


def stream_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2: each day-long batch scored alone (stateless twin)."""
    return _stream(spark, sf_dir, 86400, 86400, DAY_MAX_PCT)


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4: 4-day tumbling windows."""
    return _stream(spark, sf_dir, WINDOW, WINDOW, EVENTS_MAX_PCT)


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3/STR4: 4-day windows sliding by a day."""
    return _stream(spark, sf_dir, WINDOW, SLIDE, EVENTS_MAX_PCT)


def stream_sliding_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3/STR4 with pane state in stage 1 (one state row per day-pane and
    user instead of four); equals ``stream_sliding`` for rows on time."""
    return _stream(spark, sf_dir, WINDOW, SLIDE, EVENTS_MAX_PCT, panes=True)


def stream_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3 with slide > length: the first day of every second day."""
    return _stream(spark, sf_dir, SAMPLE_LENGTH, SAMPLE_EVERY, EVENTS_MAX_PCT)


def stream_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR10: 4-day tumbling windows that start a day and six hours late."""
    return _stream(spark, sf_dir, WINDOW, WINDOW, EVENTS_MAX_PCT, start=WINDOW_START)


def stream_json_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3: A1 as JSON lines, streamed by the arrival of their files.

    All files arrive within this run, so windows of a century hold them all
    and the scorecard is the whole data set's; the bounds are left out.
    """
    path = _review_json(spark, sf_dir, points_as_text=False)
    reviews = stream_reviews(spark, path, time=ARRIVAL, options=STREAM_OPTIONS)
    with session_conf(spark, LARGE_STATE_CONF):
        card = windowed_scorecard(
            reviews,
            scratch_path(spark, "stream-out"),
            scratch_path(spark, "stream-checkpoint"),
            CENTURY,
            delay=0,
            max_pct_negative=EVENTS_MAX_PCT,
            late="fail",
        )
    return card.drop("window_start", "window_end")


def stream_json_arrival_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2/SRC3: A1 as JSON lines whose files arrived on the day of their events,
    each arrival interval of a day scored alone."""
    events = load_table(spark, sf_dir, "events")
    path = scratch_path(spark, "arrivals-json")
    events.select(
        F.col("user_id").cast("string").alias("cuisine"),
        event_evaluation(F.col("event_type")).alias("evaluation"),
        F.col("value").cast("bigint").alias("points"),
        F.to_date("ts").alias("day"),
    ).write.partitionBy("day").json(path)
    _set_arrival_by_day(spark, path)
    reviews = stream_reviews(spark, path, time=ARRIVAL, options=STREAM_OPTIONS)
    with session_conf(spark, LARGE_STATE_CONF):
        card = windowed_scorecard(
            reviews, scratch_path(spark, "stream-out"), scratch_path(spark, "stream-checkpoint"), 86400,
            max_pct_negative=DAY_MAX_PCT, late="fail",
        )
    return card.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _set_arrival_by_day(spark: SparkSession, path: str) -> None:
    """Noon of the folder's day as the modification time of each file below ``path``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listFiles(folder, True)
    while files.hasNext():
        file = files.next().getPath()
        day = file.getParent().getName()
        if day.startswith("day="):
            noon = datetime.datetime.fromisoformat(f"{day.removeprefix('day=')}T12:00:00+00:00")
            fs.setTimes(file, int(noon.timestamp() * 1000), -1)


def stream_totals_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON1/JON2/FLT3 in the stream: sliding windows with their totals joined and
    the filters applied before the sink. A tick after the last event closes all windows.

    The join keeps seven state stores a partition, of open windows only; the session's
    state store provider is left as it is, since RocksDB takes files for each of them.
    """
    clock = ArrivalClock(spark, scratch_path(spark, "ticks"))
    events = reviews_from_events(stream_table(spark, sf_dir, "events", STREAM_OPTIONS))
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-checkpoint")
    kept = scored_stream(events, WINDOW, SLIDE, STREAM_HORIZON * SLIDE, EVENTS_MAX_PCT, ticks=clock.ticks())
    ledger = BatchLedger(spark)
    ledger.follow(start_summary_stream(kept, out, checkpoint))
    clock.close()
    ledger.follow(start_summary_stream(kept, out, checkpoint))
    ledger.account().check(f"{STREAM_HORIZON} slides")
    return read_summary(spark, out, kept.schema)


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR6: each day scored from the stream's history alone. What the drained stream has closed goes
    into a first run; a tick after the last event closes the other days, which join it."""
    clock = ArrivalClock(spark, scratch_path(spark, "ticks"))
    events = reviews_from_events(stream_table(spark, sf_dir, "events", STREAM_OPTIONS))
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-checkpoint")
    days = summarize_stream(events, 86400, delay=STREAM_HORIZON * 86400, ticks=clock.ticks())
    history = History(spark, scratch_path(spark, "history"), days.schema, period="7 days")
    ledger = BatchLedger(spark)
    with session_conf(spark, LARGE_STATE_CONF):
        ledger.follow(start_summary_stream(days, out, checkpoint))
        history.compact(read_summary(spark, out, days.schema))
        clock.close()
        ledger.follow(start_summary_stream(days, out, checkpoint))
        history.compact(read_summary(spark, out, days.schema))
    ledger.account().check(f"{STREAM_HORIZON} days")
    scope = list(WINDOW_COLUMNS)
    return score_summary(history.read(), scope=scope, max_pct_negative=DAY_MAX_PCT, materialize=False)


def scorecard_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1/Q1 kept up to date: the first run reads the table, the second one finds
    nothing new in it, and both score the stored summary."""
    events = reviews_from_events(stream_table(spark, sf_dir, "events", STREAM_OPTIONS))
    checkpoint = scratch_path(spark, "maintained")
    with session_conf(spark, LARGE_STATE_CONF):
        update_summary(events, checkpoint)
        if update_summary(events, checkpoint).rows_read:
            raise RuntimeError("the second run read files again")
    summary = read_maintained(spark, checkpoint)
    return score_summary(summary, max_pct_negative=EVENTS_MAX_PCT, order_by="points")


# -- rules, sinks, rejects ----------------------------------------------------


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as reviews of their region: every region has as many, so ``>``
    keeps none and ``>=`` keeps all."""
    return load_table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").cast("string").alias("category"),
        F.lit("positive").alias("evaluation"),
        F.col("n_nationkey").cast("bigint").alias("points"),
    )


def volume_rule_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT1 ``gt`` where every category has the average volume."""
    return scorecard(_nations(spark, sf_dir), volume_rule="gt")


def volume_rule_ge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT1 ``ge`` where every category has the average volume."""
    return scorecard(_nations(spark, sf_dir), volume_rule="ge")


def _written(spark: SparkSession, card: DataFrame, fmt: str, scope: tuple[str, ...] = ()) -> DataFrame:
    path = scratch_path(spark, f"scorecard-{fmt}")
    write_scorecard(card, path, fmt=fmt, scope=scope, partition_by_scope=bool(scope))
    reader = spark.read.schema(card.schema).format(fmt)
    return (reader.option("header", "true") if fmt == "csv" else reader).load(path).select(*card.columns)


def written_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1/SNK4: Q1 on A1 written as JSON and read back."""
    return _written(spark, scorecard_by_points_events(spark, sf_dir), "json")


def written_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2: the per-day scorecards, one folder per day, read back."""
    return _written(spark, scorecard_per_day(spark, sf_dir), "parquet", ("day",))


def json_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2 lenient with times: A1 as JSON lines in which times of errors are
    unreadable; the good and the rejected rows per category."""
    events = load_table(spark, sf_dir, "events")
    evaluation = event_evaluation(F.col("event_type"))
    path = scratch_path(spark, "reviews-times")
    events.select(
        F.col("user_id").cast("string").alias("cuisine"),
        evaluation.alias("evaluation"),
        F.col("value").cast("bigint").alias("points"),
        F.when(evaluation == "negative", F.lit("no time")).otherwise(F.col("ts").cast("string")).alias("ts"),
    ).write.json(path)
    good, rejects = read_reviews(spark, path, "lenient", needs_time=True)
    both = good.select("category", F.lit("good").alias("fate")).unionByName(
        rejects.select(F.col("cuisine").alias("category"), F.col("reason").alias("fate"))
    )
    return both.groupBy("category", "fate").agg(F.count(F.lit(1)).alias("reviews"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_points": json_points,
    "review_measures": review_measures,
    "category_summary": category_summary,
    "category_count": category_count,
    "review_count": review_count,
    "average_reviews_events": average_reviews_events,
    "average_reviews_brands": average_reviews_brands,
    "totals_attached": totals_attached,
    "totals_attached_per_day": totals_attached_per_day,
    "popular_categories": popular_categories,
    "liked_categories": liked_categories,
    "popular_brands": popular_brands,
    "liked_brands": liked_brands,
    "brand_ratios": brand_ratios,
    "scorecard_by_points_events": scorecard_by_points_events,
    "scorecard_by_points_brands": scorecard_by_points_brands,
    "scorecard_by_avg_events": scorecard_by_avg_events,
    "scorecard_by_avg_brands": scorecard_by_avg_brands,
    "scorecard_brands_per_month": scorecard_brands_per_month,
    "scorecard_per_day": scorecard_per_day,
    "scorecard_tumbling": scorecard_tumbling,
    "scorecard_sliding": scorecard_sliding,
    "scorecard_sliding_fine": scorecard_sliding_fine,
    "scorecard_sampling": scorecard_sampling,
    "scorecard_from_json": scorecard_from_json,
    "scorecard_from_json_lenient": scorecard_from_json_lenient,
    "stream_per_day": stream_per_day,
    "stream_tumbling": stream_tumbling,
    "stream_sliding": stream_sliding,
    "stream_sliding_panes": stream_sliding_panes,
    "stream_sampling": stream_sampling,
    "stream_offset": stream_offset,
    "stream_json_arrival": stream_json_arrival,
    "stream_json_arrival_days": stream_json_arrival_days,
    "stream_totals_joined": stream_totals_joined,
    "stream_compacted": stream_compacted,
    "scorecard_maintained": scorecard_maintained,
    "volume_rule_gt": volume_rule_gt,
    "volume_rule_ge": volume_rule_ge,
    "written_json": written_json,
    "written_per_day": written_per_day,
    "json_times": json_times,
}
