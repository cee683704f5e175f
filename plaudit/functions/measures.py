"""Column expressions for one review and for one category's measures.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two evaluation labels that carry points, compared after
# lower-casing and without trimming.
NEGATIVE_LABEL = "negative"
POSITIVE_LABEL = "positive"

# A decimal number; Java's own parser would also take a suffix, as in "7d".
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_negative(evaluation: Column | str = "evaluation") -> Column:
    """True for a negative review (``lower(evaluation) = 'negative'``)."""
    return F.lower(_col(evaluation)) == F.lit(NEGATIVE_LABEL)


def is_positive(evaluation: Column | str = "evaluation") -> Column:
    """True for a positive review (``lower(evaluation) = 'positive'``)."""
    return F.lower(_col(evaluation)) == F.lit(POSITIVE_LABEL)


def negative_flag(evaluation: Column | str = "evaluation") -> Column:
    """1 for a negative review, else 0 (a null label counts as 0)."""
    return F.when(is_negative(evaluation), F.lit(1)).otherwise(F.lit(0))


def signed_points(
    evaluation: Column | str = "evaluation", points: Column | str = "points"
) -> Column:
    """+points for a positive, -points for a negative, 0 for any other label."""
    p = _col(points)
    return (
        F.when(is_negative(evaluation), -p)
        .when(is_positive(evaluation), p)
        .otherwise(F.lit(0).cast("bigint"))
    )


def strict_points(points: Column | str = "points") -> Column:
    """Integer points (surrounding blanks allowed); any other text fails the job.

    Checked explicitly rather than left to the ANSI cast, so the behaviour does
    not depend on ``spark.sql.ansi.enabled``. Null stays null.
    """
    p = _col(points)
    parsed = p.try_cast("bigint")
    return F.when(
        p.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit("points is not an integer: "), p.cast("string"))),
    ).otherwise(parsed)


def lenient_points(points: Column | str = "points") -> Column:
    """Integer points truncated toward zero; null for text that is no number.

    Whole numbers never pass through a double, which holds them exactly only up
    to 2^53; the double path takes only what is written as a decimal number.
    """
    p = _col(points)
    number = F.rlike(F.trim(p.cast("string")), F.lit(NUMBER))
    return F.coalesce(p.try_cast("bigint"), F.when(number, p.try_cast("double").try_cast("bigint")))


def pct_negative(
    negatives: Column | str = "negatives", reviews: Column | str = "reviews"
) -> Column:
    """Share of negative reviews in percent, as ``negatives / reviews * 100.0``.

    The order of operations is kept on purpose: 29 / 100 * 100.0 is
    28.999999999999996, so a threshold of 29 keeps a 29 % category.
    """
    return _col(negatives) / _col(reviews) * F.lit(100.0)


def avg_points(points: Column | str = "points", reviews: Column | str = "reviews") -> Column:
    """Average signed points per review (double division)."""
    return _col(points) / _col(reviews)
