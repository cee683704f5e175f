"""STR6: the account of a stream's batches, kept by the run itself.

Spark reports what a batch read and what the watermark dropped from it in the batch's
progress, of which a query keeps the last hundred, and none after a restart. A
:class:`BatchLedger` takes every executed batch's figures by its id while the run lasts
and appends them to a folder, so the account goes on over restarts and over any number of
batches. Batch ids have no holes: an id that the ledger never saw (a driver lost between a batch
and its entry) is counted as unaccounted, and a strict run fails for it as it does for a late row,
instead of passing unseen.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "first_batch BIGINT, last_batch BIGINT, rows_read BIGINT, rows_dropped BIGINT, batches_missing BIGINT"


@dataclass(frozen=True)
class Account:
    """Up to ``last_batch``. ``rows_dropped`` counts late rows as the state operator sees
    them: once for each window, and those of one key and task together."""

    last_batch: int
    rows_read: int
    rows_dropped: int
    batches_missing: int

    def check(self, horizon: str) -> None:
        """Fail if rows were dropped or a batch is unaccounted for."""
        if self.rows_dropped:
            raise RuntimeError(f"{self.rows_dropped} rows came later than the horizon of {horizon}: late rows were dropped")
        if self.batches_missing:
            raise RuntimeError(f"{self.batches_missing} batches are not accounted for; they may have dropped late rows")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The JSON lines below ``path``, none if nothing has been written there."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class BatchLedger:
    """The account of one query. ``path`` is the ledger's folder, None to keep the account of
    this run alone, in memory; entries are appended at most every ``every`` seconds, and
    on :meth:`flush`."""

    def __init__(self, spark: SparkSession, path: str | None = None, every: float = 5.0):
        self.spark, self.path, self.every = spark, path, every
        self.last, self.read, self.dropped, self.missing = None, 0, 0, 0
        if path is not None:
            self.last = -1
            # One entry for each flush: added up by Spark, one row comes back.
            known = read_or_empty(spark, path, SCHEMA).agg(
                F.max("last_batch"), F.sum("rows_read"), F.sum("rows_dropped"), F.sum("batches_missing")
            )
            last, read, dropped, missing = known.first()
            if last is not None:
                self.last, self.read, self.dropped, self.missing = last, read, dropped, missing
        self._noted = self.account()
        self._written = time.monotonic()

    def account(self) -> Account:
        return Account(-1 if self.last is None else self.last, self.read, self.dropped, self.missing)

    def poll(self, query: StreamingQuery) -> Account:
        """Take the batches that ended since the last call; call it more often than a
        query ends as many batches as it keeps the progress of."""
        for p in query.recentProgress:
            batch = p["batchId"]
            # A trigger without a batch reports, too, under the id of the next one.
            if "addBatch" not in p["durationMs"]:
                continue
            if self.last is None:
                self.last = batch - 1
            if batch <= self.last:
                continue
            self.missing += batch - self.last - 1
            self.last = batch
            self.read += p["numInputRows"]
            self.dropped += sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
        if time.monotonic() - self._written > self.every:
            self.flush()
        return self.account()

    def flush(self) -> None:
        """Append what is new since the last entry."""
        now, old = self.account(), self._noted
        if self.path is not None and now.last_batch > old.last_batch:
            entry = (
                old.last_batch + 1, now.last_batch, now.rows_read - old.rows_read,
                now.rows_dropped - old.rows_dropped, now.batches_missing - old.batches_missing,
            )
            self.spark.createDataFrame([entry], SCHEMA).coalesce(1).write.mode("append").json(self.path)
        self._noted, self._written = now, time.monotonic()

    def follow(self, query: StreamingQuery, seconds: float | None = None, poll: float = 1.0) -> bool:
        """Wait until the query ends, ``seconds`` at most, taking its batches; whether it ended."""
        end = None if seconds is None else time.monotonic() + seconds
        ended = False
        try:
            while not ended and (end is None or time.monotonic() < end):
                wait = poll if end is None else max(0.05, min(poll, end - time.monotonic()))
                ended = bool(query.awaitTermination(wait))
                self.poll(query)
        finally:
            # A failed query's batches before the failure count as well.
            self.poll(query)
            self.flush()
        return ended
