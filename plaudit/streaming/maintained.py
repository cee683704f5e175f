"""AGG1/Q1 over a growing folder: a summary that each run brings up to date.

The batch program reads all files on every run. Here the per-category summary is the state
of a streaming aggregation without a window: the stream's checkpoint is the ledger of files
already counted, a run merges only the new ones (exactly once, also after a run that was cut off),
and the summary is read from the state store as a table and scored like any other. The state
is one row per category, spread over the shuffle partitions of the first run by key.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.operators.scorecard import score_summary
from plaudit.operators.summarize import summarize
from plaudit.streaming.ledger import Account, BatchLedger

SCHEMA = "category STRING, reviews BIGINT, negatives BIGINT, points BIGINT"


def update_summary(reviews: DataFrame, checkpoint_path: str) -> Account:
    """Merge the stream's new files into the summary below ``checkpoint_path``.

    The returned account holds the rows read by this run.
    """
    query = (
        summarize(reviews)
        .writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    ledger = BatchLedger(reviews.sparkSession)
    ledger.follow(query)
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return ledger.account()


def read_maintained(spark: SparkSession, checkpoint_path: str) -> DataFrame:
    """The summary as of the last finished run; empty before the first batch."""
    try:
        state = spark.read.format("statestore").load(checkpoint_path)
    except PySparkException as e:
        if e.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise
        return spark.createDataFrame([], SCHEMA)
    # The buffers of ``summarize``'s three aggregates, by position.
    measures = F.col("value").cast("struct<reviews:bigint,negatives:bigint,points:bigint>")
    return state.select(F.col("key.category").alias("category"), measures.alias("m")).select("category", "m.*")


def maintained_scorecard(reviews: DataFrame, checkpoint_path: str, **options) -> DataFrame:
    """Bring the summary up to date and score it; ``options`` are ``score_summary``'s."""
    update_summary(reviews, checkpoint_path)
    return score_summary(read_maintained(reviews.sparkSession, checkpoint_path), **options)
