"""AGG2-AGG5 and JON1-JON2: scope totals attached to every category row.

The reference joins one-row totals onto every group through a constant key,
which sends all groups to one task. Here the totals are an aggregate of the
summary (partial per partition, so tiny before the shuffle):

* whole data set: the one-row totals become a scalar subquery — no join, and
  the value that reaches the driver is exactly one row by construction;
* per scope: an equi-join on the scope columns without a hint. The planner
  broadcasts the totals when its estimate of them is under
  ``spark.sql.autoBroadcastJoinThreshold`` (small inputs); with a larger estimate
  it plans a sort-merge join, which AQE turns into a broadcast if the measured
  totals are under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and whose hot
  scopes it splits otherwise (skew join), so the category rows are never
  funnelled into one task per scope.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scope_totals(summary: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One row per scope: ``scope_reviews`` (AGG3/AGG4), ``scope_categories``
    (AGG2, counting the null category) and ``avg_reviews`` (AGG5)."""
    grouped = summary.groupBy(*scope) if scope else summary
    totals = grouped.agg(
        F.sum("reviews").alias("scope_reviews"),
        F.count(F.lit(1)).alias("scope_categories"),
    )
    return totals.withColumn(
        "avg_reviews", F.col("scope_reviews") / F.col("scope_categories")
    )


def with_scope_totals(summary: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Every summary row plus ``scope_reviews``, ``scope_categories``, ``avg_reviews``.

    The summary is read twice (totals and rows); pass a stored one (a
    checkpoint or table, as ``score_summary`` does) so the input behind it is
    scanned once.
    """
    totals = scope_totals(summary, scope)
    if not scope:
        one_row = totals.select(
            F.struct("scope_reviews", "scope_categories", "avg_reviews").alias("t")
        ).scalar()
        return summary.withColumns(
            {
                "scope_reviews": one_row.getField("scope_reviews"),
                "scope_categories": one_row.getField("scope_categories"),
                "avg_reviews": one_row.getField("avg_reviews"),
            }
        )
    renamed = totals.select(
        *[F.col(s).alias(f"_scope_{i}") for i, s in enumerate(scope)],
        "scope_reviews",
        "scope_categories",
        "avg_reviews",
    )
    # Null-safe keys: rows without a time fall into a null scope and still
    # meet their totals.
    cond = [summary[s].eqNullSafe(renamed[f"_scope_{i}"]) for i, s in enumerate(scope)]
    joined = summary.join(renamed, on=cond, how="inner")
    return joined.drop(*[f"_scope_{i}" for i in range(len(scope))])
