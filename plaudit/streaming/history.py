"""STR6: a bounded history of a stream's stage-1 table.

Every closing batch adds files to the stage-1 table, and the sink's file list names them
for ever, or drops them by age (``retention``) together with their rows. A :class:`History` keeps the
rows instead: :meth:`History.compact` moves what the stage-1 table has closed since the last time
into a *run*, a folder of few files partitioned by time, and :meth:`History.expire` lets whole time
partitions go.

* **Commit.** An entry of the log (one version, one folder) names the runs that make up the table,
  the end of the latest window in them and the time before which rows have expired. Readers take
  the latest entry, the runs it names and, from the stage-1 table, only the windows that
  end later. Windows leave the stream in the order of their ends, all rows of one in the same batch, so
  that end parts the two exactly; a run without an entry does not exist.
* **Bounded files.** A new run takes in the runs before it that are at most twice its size, up to
  ``full_rows``, as merge trees do: the number of small runs grows with the logarithm of the rows, and
  a row is rewritten that often. Files hold about ``rows_per_file`` rows, dealt by range of period,
  window and category, so that neither a hot window nor a hot category makes a large file.
* **Readers.** What an entry no longer names goes with the entry after it, so a frame made
  from the entry before stays readable for one more compaction.

One writer at a time, as for the stream's checkpoint. A writer lost before its entry leaves a folder
that the next one removes, and the same rows are compacted again.
"""

from __future__ import annotations

import datetime
import functools
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.functions.time import instant_to_ntz, ntz_to_instant
from plaudit.operators.windows import parse_seconds
from plaudit.streaming.ledger import read_or_empty

LOG_SCHEMA = (
    "until_micros BIGINT, expired_micros BIGINT, "
    "runs ARRAY<STRUCT<folder: STRING, n: BIGINT, until_micros: BIGINT>>, version BIGINT"
)
ROWS_PER_FILE = 4_000_000
FULL_ROWS = 1_000_000_000
# Entries that stay readable: the latest and the one before.
KEPT_VERSIONS = 2
# Files of a sink that are looked into at once before they are deleted.
FILES_AT_ONCE = 500


@dataclass(frozen=True)
class Run:
    folder: str
    n: int
    until_micros: int


@dataclass(frozen=True)
class Version:
    number: int = -1
    until_micros: int | None = None
    expired_micros: int | None = None
    runs: tuple[Run, ...] = ()


class History:
    """The history below ``path`` of a stage-1 table with ``schema``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        period: int | str = "1 day",
        rows_per_file: int = ROWS_PER_FILE,
        full_rows: int = FULL_ROWS,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.period = parse_seconds(period) * 1_000_000
        self.rows_per_file, self.full_rows = rows_per_file, full_rows
        self.ntz = isinstance(schema["window_end"].dataType, T.TimestampNTZType)
        # At most ``KEPT_VERSIONS`` entries, and one more if a writer was lost while clearing.
        known = read_or_empty(spark, f"{self.path}/log", LOG_SCHEMA).orderBy("version").collect()
        self.versions = [
            Version(r.version, r.until_micros, r.expired_micros, tuple(Run(*x) for x in r.runs or ())) for r in known
        ]

    @property
    def now(self) -> Version:
        return self.versions[-1] if self.versions else Version()

    def read(self, stored: DataFrame | None = None) -> DataFrame:
        """All closed windows that have not expired: the history's rows and those of
        ``stored``, the stage-1 table as one frame, that no compaction has taken yet."""
        rows = self._rows(self.now.runs)
        if stored is not None:
            rows = rows.unionByName(self._unexpired(self._later(stored)))
        return rows

    def compact(self, stored: DataFrame) -> bool:
        """Move the windows of ``stored`` that end after the history's into it; whether there were any."""
        now, fresh = self.now, self._unexpired(self._later(stored))
        n, until = fresh.agg(F.count(F.lit(1)), F.max(self._micros())).first()
        if not n:
            return False
        runs = list(now.runs)
        taken = []
        while runs and runs[-1].n <= 2 * n and runs[-1].n + n <= self.full_rows:
            taken.append(runs.pop())
            n += taken[-1].n
        rows = fresh.unionByName(self._rows(tuple(taken)))
        name = f"r{uuid.uuid4().hex}"
        by = ["period", "window_start", "category"]
        (
            rows.withColumn("period", self._period())
            .repartitionByRange(max(1, -(-n // self.rows_per_file)), *by)
            .sortWithinPartitions(*by)
            .write.partitionBy("period")
            .parquet(f"{self.path}/data/run={name}")
        )
        self._commit(until, now.expired_micros, (*runs, Run(name, n, until)))
        return True

    def expire(self, before: datetime.datetime) -> None:
        """Let the time partitions go whose windows all end before ``before`` (an aware time)."""
        epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
        micros = (before - epoch) // datetime.timedelta(microseconds=1) // self.period * self.period
        now = self.now
        if now.number < 0 or (now.expired_micros is not None and micros <= now.expired_micros):
            return
        self._commit(now.until_micros, micros, tuple(r for r in now.runs if r.until_micros >= micros))

    def clear_sink(self, summary_path: str, older_seconds: float) -> int:
        """Delete the stage-1 table's files that its list has dropped, that are older than
        ``older_seconds`` (longer than a batch takes, so that none is being written) and hold no row
        which the history lacks; their number."""
        listed = {f.rsplit("/", 1)[-1] for f in self.spark.read.schema(self.schema).parquet(summary_path).inputFiles()}
        limit = (time.time() - older_seconds) * 1000
        old = [
            s.getPath()
            for s in self._list(summary_path)
            if s.isFile() and s.getPath().getName().endswith(".parquet") and s.getModificationTime() < limit
        ]
        old = [p for p in old if p.getName() not in listed]
        deleted = 0
        for i in range(0, len(old), FILES_AT_ONCE):
            part = old[i : i + FILES_AT_ONCE]
            rows = self.spark.read.schema(self.schema).parquet(*[p.toString() for p in part])
            needed = self._later(rows.select("*", F.col("_metadata.file_name").alias("_file")))
            keep = {r[0] for r in needed.select("_file").distinct().collect()}
            for p in part:
                if p.getName() not in keep:
                    self._fs(p).delete(p, False)
                    deleted += 1
        return deleted

    def _rows(self, runs: tuple[Run, ...]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, T.StructField("period", T.LongType())])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        rows = reader.parquet(*[f"{self.path}/data/run={r.folder}" for r in runs])
        if self.now.expired_micros is not None:
            rows = rows.where(F.col("period") >= self.now.expired_micros // self.period)
        return rows.select(*self.schema.names)

    def _micros(self) -> Column:
        return F.unix_micros(ntz_to_instant(F.col("window_end")) if self.ntz else F.col("window_end"))

    def _period(self) -> Column:
        return F.floor(self._micros() / F.lit(self.period)).cast("long")

    def _instant(self, micros: int) -> Column:
        t = F.timestamp_micros(F.lit(micros))
        return instant_to_ntz(t) if self.ntz else t

    def _later(self, rows: DataFrame) -> DataFrame:
        until = self.now.until_micros
        return rows if until is None else rows.where(F.col("window_end") > self._instant(until))

    def _unexpired(self, rows: DataFrame) -> DataFrame:
        expired = self.now.expired_micros
        return rows if expired is None else rows.where(F.col("window_end") >= self._instant(expired))

    def _commit(self, until: int | None, expired: int | None, runs: tuple[Run, ...]) -> None:
        new = Version(self.now.number + 1, until, expired, runs)
        schema = LOG_SCHEMA.rsplit(",", 1)[0]
        row = (until, expired, [(r.folder, r.n, r.until_micros) for r in runs])
        entry = self.spark.createDataFrame([row], schema).coalesce(1)
        # A writer lost here before its commit may have left the folder of this number.
        entry.write.mode("overwrite").json(f"{self.path}/log/version={new.number}")
        self.versions.append(new)
        self._clear()

    def _clear(self) -> None:
        """Remove entries, runs and time partitions that no kept entry names."""
        kept = self.versions[-KEPT_VERSIONS:]
        named = {f"run={r.folder}" for v in kept for r in v.runs}
        expired = kept[0].expired_micros
        for s in self._list(f"{self.path}/data"):
            if s.getPath().getName() not in named:
                self._fs(s.getPath()).delete(s.getPath(), True)
            elif expired is not None:
                for p in self._list(s.getPath().toString()):
                    key, _, value = p.getPath().getName().partition("=")
                    if key == "period" and int(value) < expired // self.period:
                        self._fs(p.getPath()).delete(p.getPath(), True)
        numbers = {f"version={v.number}" for v in kept}
        for s in self._list(f"{self.path}/log"):
            if s.getPath().getName() not in numbers:
                self._fs(s.getPath()).delete(s.getPath(), True)
        self.versions = kept

    @functools.cached_property
    def _hadoop(self):
        sc = self.spark.sparkContext
        return sc._jvm.org.apache.hadoop.fs.Path, sc._jsc.hadoopConfiguration()

    def _fs(self, path):
        return path.getFileSystem(self._hadoop[1])

    def _list(self, folder: str) -> list:
        path = self._hadoop[0](folder)
        fs = self._fs(path)
        return list(fs.listStatus(path)) if fs.exists(path) else []
