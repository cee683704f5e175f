"""STR2/STR8: results for intervals after which no file comes.

A watermark moves with the rows it sees, so a folder that falls quiet would keep its last
windows open. The reference's clock closes them; here an :class:`ArrivalClock` does, as a
second source: a small table of *ticks*, each the time of a trigger that found the folder without a new
file. The stream unites it with the reviews, its times move the arrival watermark,
and its rows are left out before the windows (``summarize_stream(ticks=…)``).

A tick is written only for a trigger that listed the folder and had no batch to run. So
no backlog can be behind it, whatever the bytes or files of a batch are bounded to: every file that was
visible by the tick's time has been read. Ticks are stored rows, so a restart sees the same
ones. None is written while no window is open, which bounds their number by that of the
closed windows. A file that becomes visible later than it was modified by more than the
horizon (or clocks that differ by more) is late, as ever, and accounted for.
"""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Triggers without a batch report at once (the default is every ten seconds).
IDLE_CONF = {"spark.sql.streaming.noDataProgressEventInterval": "0"}
SCHEMA = "ts TIMESTAMP"
# Moves no watermark.
FIRST = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
# Closes all windows.
LAST = datetime.datetime(9000, 1, 1, tzinfo=datetime.timezone.utc)


def idle_since(progress: dict | None) -> datetime.datetime | None:
    """When a trigger began that found nothing to read, else None."""
    if progress is None or "addBatch" in progress["durationMs"]:
        return None
    return datetime.datetime.fromisoformat(progress["timestamp"])


class ArrivalClock:
    """Ticks in the folder ``path``, made with a first one that moves nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        try:
            self.last = spark.read.schema(SCHEMA).parquet(path).agg(F.max(F.unix_micros("ts"))).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            self.last = None
        if self.last is None:
            self._write(FIRST)

    def _write(self, at: datetime.datetime) -> None:
        micros = (at - FIRST) // datetime.timedelta(microseconds=1)
        tick = self.spark.range(1).select(F.timestamp_micros(F.lit(micros)).alias("ts"))
        tick.coalesce(1).write.mode("append").parquet(self.path)
        self.last = micros

    def ticks(self) -> DataFrame:
        return self.spark.readStream.schema(SCHEMA).parquet(self.path)

    def close(self) -> None:
        """A last tick, later than any review: the next batch closes every window, and reviews
        that come after it are late. For streams that have ended."""
        self._write(LAST)

    def advance(self, query: StreamingQuery) -> bool:
        """Write a tick if the query's last trigger was idle and windows are open."""
        progress = query.lastProgress
        at = idle_since(progress)
        if at is None or (at - FIRST) // datetime.timedelta(microseconds=1) <= self.last:
            return False
        operators = progress["stateOperators"]
        if operators and not any(op["numRowsTotal"] for op in operators):
            return False
        self._write(at)
        return True
