"""Review-shaped rows from the driver's tables (there is no review table).

A1 ``events``: category = user, ``error`` is a negative review, ``purchase``
and ``signup`` are positive, other event types are neutral; points are the
event value truncated toward zero.

A2 ``lineitem`` ⋈ ``part``: category = brand, return flag ``R`` is negative,
``A`` positive, ``N`` neutral; points are the quantity truncated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.functions.measures import NEGATIVE_LABEL, POSITIVE_LABEL
from plaudit.operators.summarize import merge_summaries, summarize

# Event types that map to a review label (others are neutral).
EVENT_NEGATIVE_TYPES = ("error",)
EVENT_POSITIVE_TYPES = ("purchase", "signup")

# Return flags that map to a review label (N is neutral).
RETURNFLAG_NEGATIVE = "R"
RETURNFLAG_POSITIVE = "A"


def event_evaluation(event_type: Column) -> Column:
    return (
        F.when(event_type.isin(*EVENT_NEGATIVE_TYPES), F.lit(NEGATIVE_LABEL))
        .when(event_type.isin(*EVENT_POSITIVE_TYPES), F.lit(POSITIVE_LABEL))
        .otherwise(event_type)
    )


def returnflag_evaluation(flag: Column) -> Column:
    return (
        F.when(flag == F.lit(RETURNFLAG_NEGATIVE), F.lit(NEGATIVE_LABEL))
        .when(flag == F.lit(RETURNFLAG_POSITIVE), F.lit(POSITIVE_LABEL))
        .otherwise(F.lit("neutral"))
    )


def reviews_from_events(events: DataFrame, with_id: bool = False) -> DataFrame:
    """A1: ``(category, evaluation, points, ts)`` from ``events``."""
    cols = [
        F.col("user_id").cast("string").alias("category"),
        event_evaluation(F.col("event_type")).alias("evaluation"),
        F.col("value").cast("bigint").alias("points"),
        F.col("ts"),
    ]
    if with_id:
        cols.insert(0, F.col("event_id"))
    return events.select(*cols)


def reviews_from_lineitem(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """A2 review rows: one per line item with a known part."""
    items = lineitem.select(
        "l_partkey",
        returnflag_evaluation(F.col("l_returnflag")).alias("evaluation"),
        F.col("l_quantity").cast("bigint").alias("points"),
        "l_shipdate",
    )
    brands = part.select(F.col("p_partkey"), F.col("p_brand").alias("category"))
    return items.join(brands, items["l_partkey"] == brands["p_partkey"]).select(
        "category", "evaluation", "points", F.col("l_shipdate").alias("ts")
    )


def ship_month(lineitem: DataFrame) -> Column:
    """Scope column: first day of the ship month (DATE)."""
    return F.trunc(F.to_date(lineitem["l_shipdate"]), "month")


def brand_summary(
    lineitem: DataFrame, part: DataFrame, scope: Mapping[str, Column] | None = None
) -> DataFrame:
    """A2 summarised per ``(scope…, brand)``, aggregating *before* the join.

    Line items are first reduced to one row per (scope, part key), map-side
    combined, so the join with ``part`` sees one row per part instead of one
    per line item, and a hot part key never reaches the join as a skewed key.
    The per-part summary is already hash-partitioned on its keys; the final
    merge groups by brand. ``scope`` maps names to expressions over
    ``lineitem`` (e.g. ``{"month": ship_month(lineitem)}``).
    """
    scope = dict(scope or {})
    per_part = summarize(
        lineitem.select(
            *[expr.alias(name) for name, expr in scope.items()],
            F.col("l_partkey").alias("category"),
            returnflag_evaluation(F.col("l_returnflag")).alias("evaluation"),
            F.col("l_quantity").cast("bigint").alias("points"),
        ),
        scope=list(scope),
    )
    brands = part.select("p_partkey", "p_brand")
    joined = per_part.join(brands, per_part["category"] == brands["p_partkey"]).select(
        *scope, F.col("p_brand").alias("category"), "reviews", "negatives", "points"
    )
    return merge_summaries(joined, scope=list(scope))
