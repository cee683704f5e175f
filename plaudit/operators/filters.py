"""FLT1-FLT3: keep categories with above-average volume and a small negative share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOLUME_RULES = ("gt", "ge")


def popular(volume_rule: str = "gt") -> Column:
    """FLT1: ``reviews > avg_reviews`` (``gt``, the default) or ``>=`` (``ge``)."""
    if volume_rule == "gt":
        return F.col("reviews") > F.col("avg_reviews")
    if volume_rule == "ge":
        return F.col("reviews") >= F.col("avg_reviews")
    raise ValueError(f"volume_rule must be one of {VOLUME_RULES}, got {volume_rule!r}")


def liked(max_pct_negative: float) -> Column:
    """FLT2: ``pct_negative < max_pct_negative`` (strict)."""
    return F.col("pct_negative") < F.lit(float(max_pct_negative))


def keep_popular(df: DataFrame, volume_rule: str = "gt") -> DataFrame:
    return df.where(popular(volume_rule))


def keep_liked(df: DataFrame, max_pct_negative: float) -> DataFrame:
    return df.where(liked(max_pct_negative))


def keep_popular_and_liked(
    df: DataFrame, max_pct_negative: float, volume_rule: str = "gt"
) -> DataFrame:
    """FLT3: both rules in one predicate."""
    return df.where(popular(volume_rule) & liked(max_pct_negative))
