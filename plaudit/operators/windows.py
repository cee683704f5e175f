"""Time scopes for batch data: calendar day, tumbling, sliding and sampling windows.

A sliding window of length ``w`` and slide ``s`` puts every review into
``w / s`` windows. ``F.window`` does that with an ``Expand`` of every input
row before aggregation. Here the reviews are first summarised per *pane* of
``gcd(w, s)`` (each review in exactly one pane), and only the pane summaries
— one row per (pane, category), far fewer than reviews — are expanded into
the windows that contain them and added up ("panes": Li et al., SIGMOD Record
2005). Window alignment is Spark's own (``F.window``: epoch-aligned, plus an
optional ``start`` offset), for TIMESTAMP and TIMESTAMP_NTZ alike.

Windows of many slides (30 days by the minute: 43,200 windows hold each pane) are not
expanded pane by pane but by running sums (``sums``): a pane adds its measures at the
first window that holds it and takes them away at the first later one that does not, so a
category's windows are the running sums of these changes, constant between two of
them. Only windows that hold a review are written out, each once. The running sums are
taken in chunks of ``CHUNK_SLIDES`` slides, whose totals are summed up on their own, so
a category that holds most panes is spread over tasks, too.

Rows without a time belong to no window: they fail the job, or are dropped where
the caller says so (``missing_time="drop"``).
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.functions.time import instant_to_ntz, ntz_to_instant
from plaudit.operators.summarize import merge_summaries, summarize

WINDOW_COLUMNS = ("window_start", "window_end")
MEASURES = ("reviews", "negatives", "points")
METHODS = ("auto", "expand", "sums")
# Panes of at most this many windows are expanded: fewer shuffles than running sums.
EXPANDED_WINDOWS = 8
# A category's changes in one running sum.
CHUNK_SLIDES = 4096


def parse_seconds(duration: int | str) -> int:
    """``345600``, ``"4 days"``, ``"90 minutes"``, ``"7d"`` … to whole seconds."""
    if isinstance(duration, int):
        return duration
    names = {1: "s sec second", 60: "m min minute", 3600: "h hour", 86400: "d day", 604800: "w week"}
    factors = {name: seconds for seconds, listed in names.items() for name in listed.split()}
    parts = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]+)\s*", duration)
    unit = parts and parts[2].lower()
    if unit not in factors and unit:
        unit = unit.removesuffix("s")
    if unit not in factors:
        raise ValueError(f"unsupported duration {duration!r}")
    return int(parts[1]) * factors[unit]


def with_day(reviews: DataFrame, time_col: str = "ts", name: str = "day") -> DataFrame:
    """Scope column ``day`` = calendar date of the review time."""
    return reviews.withColumn(name, F.to_date(F.col(time_col)))


def pane_seconds(duration: int | str, slide: int | str | None = None) -> int:
    """Length of the pane that tiles both the windows and their slide."""
    w = parse_seconds(duration)
    s = parse_seconds(slide) if slide is not None else w
    if w <= 0 or s <= 0:
        raise ValueError("window duration and slide must be positive")
    return math.gcd(w, s)


def summarize_windows(
    reviews: DataFrame,
    time_col: str,
    duration: int | str,
    slide: int | str | None = None,
    start: int | str = 0,
    missing_time: str = "fail",
) -> DataFrame:
    """AGG1 per ``(window_start, window_end, category)``.

    ``slide`` defaults to ``duration`` (tumbling). ``slide < duration`` gives
    sliding windows, the first of which may cover time before the first
    review; ``slide > duration`` samples the first ``duration`` of every
    ``slide``.
    """
    pane = pane_seconds(duration, slide)
    # F.window wants an offset below its slide; the same alignment modulo the
    # pane keeps panes inside windows.
    pane_offset = f"{parse_seconds(start) % pane} seconds"
    if missing_time not in ("fail", "drop"):
        raise ValueError(f"missing_time must be 'fail' or 'drop', got {missing_time!r}")
    time = F.col(time_col)
    if missing_time == "fail":
        # In the column itself: a filter before F.window could be moved behind
        # the one for nulls that F.window brings along.
        time = F.when(time.isNull(), F.raise_error(F.lit("review without a time"))).otherwise(time)
    timed = reviews.withColumn(time_col, time).where(F.col(time_col).isNotNull())
    panes = summarize(
        timed.withColumn(
            "pane_start", F.window(time_col, f"{pane} seconds", startTime=pane_offset).getField("start")
        ),
        scope=["pane_start"],
    )
    return windows_from_panes(panes, duration, slide, start)


def windows_from_panes(
    panes: DataFrame,
    duration: int | str,
    slide: int | str | None = None,
    start: int | str = 0,
    method: str = "auto",
) -> DataFrame:
    """Per-window measures from per-pane ones ``(pane_start, category, …)``.

    Panes must be ``pane_seconds(duration, slide)`` long and aligned like the
    windows (same ``start``). ``method="expand"`` sends each pane row to the
    windows that contain it and adds the measures up; ``"sums"`` takes running sums
    of what changes between windows, and writes out as many rows as there are
    results; ``"auto"`` takes the sums where a pane is in more than
    ``EXPANDED_WINDOWS`` windows. All give the same rows.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    w = parse_seconds(duration)
    s = parse_seconds(slide) if slide is not None else w
    offset = parse_seconds(start) % s
    if w == s:
        windows = panes.withColumnRenamed("pane_start", "window_start")
    elif method == "sums" or (method == "auto" and w > EXPANDED_WINDOWS * s):
        windows = _by_running_sums(panes, w, s, offset)
    else:
        windows = _by_expansion(panes, w, s, offset)
    return windows.select(
        "window_start",
        F.timestamp_add("SECOND", F.lit(w), F.col("window_start")).alias("window_end"),
        "category",
        *MEASURES,
    )


def _by_expansion(panes: DataFrame, w: int, s: int, offset: int) -> DataFrame:
    # Latest window start at or before the pane, then the earlier ones
    # that still reach past it.
    last_start = F.window("pane_start", f"{s} seconds", startTime=f"{offset} seconds").getField("start")
    per_pane = math.ceil(w / s)
    expanded = (
        panes.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(per_pane - 1))))
        .withColumn("window_start", F.timestamp_add("SECOND", F.col("_k") * (-s), last_start))
        .where(F.col("pane_start") < F.timestamp_add("SECOND", F.lit(w), F.col("window_start")))
    )
    return merge_summaries(expanded, scope=["window_start"])


def _by_running_sums(panes: DataFrame, w: int, s: int, offset: int) -> DataFrame:
    ntz = isinstance(panes.schema["pane_start"].dataType, T.TimestampNTZType)
    pane = F.unix_seconds(ntz_to_instant(F.col("pane_start")) if ntz else F.col("pane_start"))

    def first_start_after(t: Column) -> Column:
        return t - F.pmod(t - offset, F.lit(s)) + s

    # A window holds a pane if it starts at or before it and less than w before it.
    changes = F.array(
        F.struct(first_start_after(pane - w).alias("at"), F.lit(1).alias("sign")),
        F.struct(first_start_after(pane).alias("at"), F.lit(-1).alias("sign")),
    )
    steps = (
        panes.select("category", *MEASURES, F.explode(changes).alias("c"))
        .groupBy("category", F.col("c.at").alias("_at"))
        .agg(*[F.sum(F.col(m) * F.col("c.sign")).alias(m) for m in MEASURES])
        .withColumn("_chunk", F.floor((F.col("_at") - offset) / (s * CHUNK_SLIDES)))
    )
    # What a category's earlier chunks add up to, and where its next one begins.
    in_order = Window.partitionBy("category").orderBy("_chunk")
    chunks = (
        steps.groupBy("category", "_chunk")
        .agg(F.min("_at").alias("_first"), *[F.sum(m).alias(m) for m in MEASURES])
        .select(
            F.col("category").alias("_category"),
            F.col("_chunk").alias("_c"),
            F.lead("_first").over(in_order).alias("_following"),
            *[(F.sum(m).over(in_order) - F.col(m)).alias(f"_{m}") for m in MEASURES],
        )
    )
    both = steps.join(
        chunks, F.col("category").eqNullSafe(F.col("_category")) & (F.col("_chunk") == F.col("_c"))
    )
    inside = Window.partitionBy("category", "_chunk").orderBy("_at")
    running = both.select(
        "category",
        "_at",
        F.coalesce(F.lead("_at").over(inside), F.col("_following")).alias("_next"),
        *[(F.sum(m).over(inside) + F.col(f"_{m}")).alias(m) for m in MEASURES],
    )
    # Nothing is left behind the last change, which has no next one.
    held = running.where(F.col("reviews") > 0).withColumn(
        "_start", F.explode(F.sequence(F.col("_at"), F.col("_next") - s, F.lit(s).cast("long")))
    )
    begin = F.timestamp_seconds("_start")
    return held.select((instant_to_ntz(begin) if ntz else begin).alias("window_start"), "category", *MEASURES)
