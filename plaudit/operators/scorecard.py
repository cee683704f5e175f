"""The scorecard (G1-G4): one operator, any scope.

``scope`` is the list of columns over which the average volume is computed
and categories compete: ``[]`` for the whole data set (the batch program),
``["day"]`` or a batch id for per-batch scoring, ``["window_start",
"window_end"]`` for windows.

Plan, per scope S:

    summarize  (partial + final HashAggregate on S, category)
    checkpoint (reliable; the summary feeds both the totals and the rows)
    totals     (partial aggregate of the summary; scalar subquery or AQE join)
    ratios, filter
    rank       (range sort + partition offsets; see ``rank.py``)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.functions.measures import avg_points, pct_negative
from plaudit.operators.filters import keep_popular_and_liked, popular
from plaudit.operators.rank import ordinal_rank
from plaudit.operators.summarize import summarize
from plaudit.operators.totals import with_scope_totals
from plaudit.schema import SCORECARD_COLUMNS

ORDER_KEYS = ("avg_points", "points")


def with_ratios(df: DataFrame) -> DataFrame:
    """PRJ8 ``pct_negative`` and PRJ9 ``avg_points``."""
    return df.withColumns(
        {"pct_negative": pct_negative("negatives", "reviews"), "avg_points": avg_points("points", "reviews")}
    )


def sort_order(order_by: str = "avg_points") -> list[Column]:
    """Descending by ``avg_points`` (default) or ``points``; ties by category."""
    if order_by not in ORDER_KEYS:
        raise ValueError(f"order_by must be one of {ORDER_KEYS}, got {order_by!r}")
    return [F.col(order_by).desc(), F.col("category").asc_nulls_first()]


def score_summary(
    summary: DataFrame,
    scope: Sequence[str] = (),
    max_pct_negative: float = 10.0,
    volume_rule: str = "gt",
    order_by: str = "avg_points",
    materialize: bool = True,
) -> DataFrame:
    """Scorecard from per-category measures ``(scope…, category, reviews,
    negatives, points)``.

    ``materialize`` checkpoints the summary so that the totals and the rows
    read it once instead of re-running the scan and aggregation; leave it on
    unless the summary is already a stored table.
    """
    scope = list(scope)
    order = sort_order(order_by)  # check the arguments before any job runs
    popular(volume_rule)
    if materialize:
        summary = summary.checkpoint(eager=True)
    scored = with_ratios(with_scope_totals(summary, scope))
    kept = keep_popular_and_liked(scored, max_pct_negative, volume_rule)
    ranked = ordinal_rank(kept, order, scope)
    return ranked.select(*scope, *SCORECARD_COLUMNS)


def scorecard(
    reviews: DataFrame,
    scope: Sequence[str] = (),
    max_pct_negative: float = 10.0,
    volume_rule: str = "gt",
    order_by: str = "avg_points",
) -> DataFrame:
    """Scorecard from review rows ``(scope…, category, evaluation, points)``.

    Defaults follow the reference's code: volume strictly above the scope's
    average, negative share strictly below ``max_pct_negative``, sorted by
    average points per review (its batch program sorted by total points:
    pass ``order_by="points"``).
    """
    return score_summary(
        summarize(reviews, scope), scope, max_pct_negative, volume_rule, order_by
    )
