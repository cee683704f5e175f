"""SNK2/SNK4: which windows have been published, over restarts.

A :class:`ReportLog` holds one entry for each report that is wholly written: the end
of the latest closed window in it and the batch it was made after. A run starts from the latest
entry: it scores only windows that end later and adds their folders, so what was published stays,
also when the stage-1 table no longer lists its rows. A driver lost between the report and
its entry makes the next run write the same folders again, with the same rows.
"""

from __future__ import annotations

import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from plaudit.streaming.ledger import read_or_empty

SCHEMA = "until_micros BIGINT, batch BIGINT"


class ReportLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        entries = read_or_empty(spark, path, SCHEMA)
        n, until = entries.agg(F.count(F.lit(1)), F.max("until_micros")).first()
        self.empty, self.until_micros = n == 0, until

    @property
    def until(self) -> datetime.datetime | None:
        """The end of the latest published closed window."""
        if self.until_micros is None:
            return None
        epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
        return epoch + datetime.timedelta(microseconds=self.until_micros)

    def commit(self, until_micros: int | None, batch: int) -> None:
        """Call it when the report's folders are written."""
        entry = [(until_micros, batch)]
        self.spark.createDataFrame(entry, SCHEMA).coalesce(1).write.mode("append").json(self.path)
        self.empty = False
        if until_micros is not None:
            self.until_micros = max(until_micros, self.until_micros or until_micros)
