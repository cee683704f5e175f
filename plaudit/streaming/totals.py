"""JON1/JON2/FLT3 inside the stream: window totals joined to the window's groups.

Chained stateful operators in append mode: reviews are aggregated per (window, category), those
groups per window, and the two streams joined on the window. A window's groups, its totals and
the joined rows come out in the batch that closes it, so the scorecard's
filters run in the stream and its sink holds the kept rows, without a second job. What
the stream cannot do is the rank, which stays a column of the batch report.

The totals' side aggregates the groups a second time, from a scan of its own: twice the
work of stage 1 alone for results one batch earlier. The join's state holds a window until the watermark
has passed it; totals are one row per window, so hot windows are joined by key in as many
rows as they have categories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.operators.filters import keep_popular_and_liked
from plaudit.operators.scorecard import with_ratios
from plaudit.operators.summarize import summarize
from plaudit.streaming.windowed import window_rows, windowed_reviews


def stream_with_totals(groups: DataFrame) -> DataFrame:
    """JON1/JON2: every closed (window, category) row of ``groups`` (a streaming aggregate with
    its ``_window``) with ``scope_reviews``, ``scope_categories`` and ``avg_reviews``."""
    totals = groups.groupBy("_window").agg(
        F.sum("reviews").alias("scope_reviews"), F.count(F.lit(1)).alias("scope_categories")
    )
    joined = groups.alias("g").join(totals.alias("t"), F.expr("g._window = t._window"))
    return joined.select(
        "g._window", "category", "reviews", "negatives", "points", "scope_reviews", "scope_categories",
        (F.col("scope_reviews") / F.col("scope_categories")).alias("avg_reviews"),
    )


def stream_scored(groups: DataFrame, max_pct_negative: float = 10.0, volume_rule: str = "gt") -> DataFrame:
    """The scorecard of every closed window but for its rank, as a stream."""
    scored = with_ratios(stream_with_totals(groups))
    return keep_popular_and_liked(scored, max_pct_negative, volume_rule)


def scored_stream(
    reviews: DataFrame,
    duration: int | str,
    slide: int | str | None = None,
    delay: int | str | None = None,
    max_pct_negative: float = 10.0,
    volume_rule: str = "gt",
    time_col: str = "ts",
    start: int | str = 0,
    ticks: DataFrame | None = None,
) -> DataFrame:
    """``summarize_stream`` with the scorecard's totals, ratios and filters in the stream."""
    timed, length, ntz = windowed_reviews(reviews, duration, slide, delay, time_col, start, ticks)
    kept = stream_scored(summarize(timed, scope=["_window"]), max_pct_negative, volume_rule)
    return window_rows(kept, length, ntz, "pct_negative", "avg_reviews", "avg_points")
