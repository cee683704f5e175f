"""Column expressions (projections PRJ2-PRJ9)."""

from plaudit.functions.measures import (
    NEGATIVE_LABEL,
    POSITIVE_LABEL,
    avg_points,
    is_negative,
    is_positive,
    lenient_points,
    negative_flag,
    pct_negative,
    signed_points,
    strict_points,
)

__all__ = [
    "NEGATIVE_LABEL",
    "POSITIVE_LABEL",
    "avg_points",
    "is_negative",
    "is_positive",
    "lenient_points",
    "negative_flag",
    "pct_negative",
    "signed_points",
    "strict_points",
]
