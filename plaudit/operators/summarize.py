"""AGG1: per-category measures, optionally within a scope (batch, day, window).

``groupBy(...).agg(...)`` plans as a partial ``HashAggregate`` before the
shuffle and a final one after it, so a hot category costs one partial row
per input partition, not one shuffled row per review.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.functions.measures import is_negative, signed_points


def summarize(reviews: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Reviews ``(scope…, category, evaluation, points)`` to one row per
    ``(scope…, category)`` with ``reviews``, ``negatives`` and ``points``.

    ``points`` must already be an integer column (see ``sources``). A null
    category is a group of its own.
    """
    return reviews.groupBy(*scope, "category").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(is_negative("evaluation")).alias("negatives"),
        F.sum(signed_points("evaluation", "points")).alias("points"),
    )


def merge_summaries(summary: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Add up partial summaries that share ``(scope…, category)``.

    Lets a caller aggregate early (before a join, or per pane of time) and
    finish the per-category measures later; the result equals
    ``summarize`` over the underlying reviews.
    """
    return summary.groupBy(*scope, "category").agg(
        F.sum("reviews").alias("reviews"),
        F.sum("negatives").alias("negatives"),
        F.sum("points").alias("points"),
    )
