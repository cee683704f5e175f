"""Input and output schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Review rows as read from JSON lines. ``points`` is read as text so that
# both the JSON number 7 and the JSON string "7" arrive, then cast.
REVIEW_JSON_SCHEMA = T.StructType(
    [
        T.StructField("cuisine", T.StringType(), True),
        T.StructField("evaluation", T.StringType(), True),
        T.StructField("points", T.StringType(), True),
        T.StructField("ts", T.TimestampType(), True),
    ]
)

# Review rows as the operators consume them.
REVIEW_COLUMNS = ("category", "evaluation", "points")

# Per-category measures produced by ``summarize``.
MEASURE_COLUMNS = ("reviews", "negatives", "points")

# Scorecard columns after the scope columns.
SCORECARD_COLUMNS = (
    "category",
    "reviews",
    "negatives",
    "points",
    "pct_negative",
    "avg_reviews",
    "avg_points",
    "rank",
)
