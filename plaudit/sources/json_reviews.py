"""SRC1/SRC2: JSON-lines reviews, batch; SRC2 also for JSON held in a column.

Two modes:

* ``strict`` — the reference's behaviour (any bad line fails the job):
  ``FAILFAST`` parsing, an ANSI cast of ``points`` (``"3.5"`` fails), and an
  error for a null ``evaluation`` or ``points``. Blank lines are skipped.
* ``lenient`` — malformed lines and rows that cannot be scored go to a reject
  frame (with a ``reason``), the rest is scored. ``points`` is truncated
  toward zero (``3.7`` → 3, ``" 7 "`` → 7); text that is no number is
  rejected.

Times are read as text and parsed here, and every check is a filter over all
columns it concerns, so a row's fate does not depend on which columns the
consumer reads. A time that is there but unreadable is a bad row; one that is
missing is, too, where ``needs_time`` asks for it.

A missing ``cuisine`` and a JSON ``null`` are the same to the reader: both
form the null category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.functions.measures import lenient_points, strict_points
from plaudit.schema import REVIEW_JSON_SCHEMA

MODES = ("strict", "lenient")
CORRUPT = "_corrupt_record"
# Where a rejected line came from: its file, the part of it that the task read, and the file's time.
ORIGIN = {
    "file": "file_path",
    "block_start": "file_block_start",
    "block_length": "file_block_length",
    "modified": "file_modification_time",
}


def with_origin(raw: DataFrame) -> DataFrame:
    """Rows read from files with the ``ORIGIN`` columns; ones that nothing reads cost nothing."""
    return raw.withColumns({name: F.col(f"_metadata.{field}") for name, field in ORIGIN.items()})


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """``schema`` plus the column that holds a malformed line (lenient mode)."""
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])


def times_as_text(schema: T.StructType, *more: str) -> T.StructType:
    """``schema`` with its timestamp columns, and the columns ``more``, as text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType(), True)
            if isinstance(f.dataType, T.TimestampType) or f.name in more
            else f
            for f in schema.fields
        ]
    )


def _time(raw: DataFrame) -> Column:
    """``ts`` as a timestamp, null where it is unreadable."""
    if isinstance(raw.schema["ts"].dataType, T.StringType):
        return F.col("ts").try_cast("timestamp")
    return F.col("ts")


def _bad_time(raw: DataFrame, needs_time: bool) -> Column:
    unreadable = _time(raw).isNull()
    return unreadable if needs_time else unreadable & F.col("ts").isNotNull()


def strict_rows(raw: DataFrame, needs_time: bool = False) -> DataFrame:
    """Parsed JSON → reviews; a missing evaluation, points or (``needs_time``)
    time, or an unreadable value, fails the job."""
    fail = lambda text: F.raise_error(F.lit(text)).cast("boolean")
    checked = (
        F.when(F.col("evaluation").isNull(), fail("review without evaluation"))
        .when(F.col("points").isNull(), fail("review without points"))
        .when(_bad_time(raw, needs_time), fail("review without a readable time"))
        .otherwise(strict_points("points").isNotNull())
    )
    return raw.where(checked).select(
        F.col("cuisine").alias("category"), "evaluation", strict_points("points").alias("points"), _time(raw).alias("ts")
    )


def _reject_reason(raw: DataFrame, points: Column, needs_time: bool) -> Column:
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
        .when(F.col("evaluation").isNull(), F.lit("no evaluation"))
        .when(points.isNull(), F.lit("bad points"))
        .when(_bad_time(raw, needs_time), F.lit("bad time"))
    )


def read_reviews(
    spark: SparkSession,
    path: str,
    mode: str = "strict",
    schema: T.StructType = REVIEW_JSON_SCHEMA,
    rejected: Observation | None = None,
    needs_time: bool = False,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Reviews ``(category, evaluation, points, ts)`` from JSON lines.

    ``strict`` returns the reviews; ``lenient`` returns ``(reviews, rejects)``
    where ``rejects`` has the raw line (or parsed fields), a ``reason`` and the line's ``ORIGIN``.
    ``rejected`` (lenient) counts the rejected rows as ``rejected.get["rejected"]``
    while the reviews are consumed, so a caller can skip a second scan for
    the rejects when there are none.
    """
    schema = times_as_text(schema)
    if mode == "strict":
        raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
        return strict_rows(raw, needs_time)
    if mode != "lenient":
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    raw = (
        spark.read.schema(with_corrupt_column(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    return split_lenient(with_origin(raw), rejected, needs_time)


def split_lenient(
    raw: DataFrame, rejected: Observation | None = None, needs_time: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Parsed rows with a ``_corrupt_record`` column → ``(reviews, rejects)``.

    Rows ``with_origin`` keep it in the rejects.
    """
    points = lenient_points("points")
    reason = _reject_reason(raw, points, needs_time)
    tagged = raw.withColumn("_points", points).withColumn("reason", reason)
    if rejected is not None:
        tagged = tagged.observe(rejected, F.count_if(F.col("reason").isNotNull()).alias("rejected"))
    good = tagged.where(F.col("reason").isNull()).select(
        F.col("cuisine").alias("category"),
        "evaluation",
        F.col("_points").alias("points"),
        _time(raw).alias("ts"),
    )
    rejects = tagged.where(F.col("reason").isNotNull()).select(
        F.col(CORRUPT).alias("line"), "cuisine", "evaluation", "points", "ts", "reason",
        *[c for c in ORIGIN if c in raw.columns],
    )
    return good, rejects


def parse_json_column(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """SRC2 on lines that sit in a column: ``from_json`` into a struct ``parsed``."""
    return df.withColumn("parsed", F.from_json(F.col(column), schema))
