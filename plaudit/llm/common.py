"""Helpers shared by the corpus operators: tables, lineage cuts, held-out
rows, gapless numbering and connected components."""

from __future__ import annotations

import tempfile
import zipfile
from contextlib import AbstractContextManager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.session import ensure_checkpoint_dir, scratch_path, session_conf

# The largest table, in rows, that these operators ship to every executor.
BROADCAST_ROWS = 200_000
# Texts that a Python worker holds at once.
BATCH_TEXTS = 1000
TEXTS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"
WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that its
    functions run where it isn't installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        bundle = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"
        with zipfile.ZipFile(bundle, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(str(bundle))
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it again:
    like :func:`cut`, but compressed and read by columns."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs of a block hand texts to Python workers ``BATCH_TEXTS`` at a time, and not the
    ten thousand that are usual for numbers: memory on both sides."""
    return session_conf(spark, {TEXTS_AT_ONCE: str(BATCH_TEXTS)})


def keep_text_batches(spark: SparkSession) -> None:
    """:func:`text_batches` for the rest of the session, for results that are written
    later. A smaller setting stays."""
    if not 0 < int(spark.conf.get(TEXTS_AT_ONCE)) <= BATCH_TEXTS:
        spark.conf.set(TEXTS_AT_ONCE, str(BATCH_TEXTS))


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if its counted ``rows`` are within ``limit``;
    beyond it the join is left to the planner."""
    return F.broadcast(df) if rows <= limit else df


def held_out(doc_id: Column) -> Column:
    """The fold no label is learned from: crc32 of the id's digits, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def uniform(*cols: Column) -> Column:
    """A number in (0, 1) from a 64-bit hash of ``cols``; the same on every run."""
    high = F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double")
    return (high + F.lit(0.5)) * F.lit(2.0**-53)


def components(spark: SparkSession, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)``.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every
    edge is moved towards the smallest neighbour until the edges are stars
    around each component's smallest node. Partial minima are taken before
    each shuffle and written, so that a hub's edges meet them in a plain join of
    two tables, which Spark can split where it is skewed. The number of rounds
    grows with the logarithm of a component's diameter.
    """
    now = cut(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    stamp = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = cut(
            both.where("b > a").join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        low2 = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        linked = large.join(low2, "a")
        step = (
            linked.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low2.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = cut(step)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == stamp:
            break
        stamp = mark
    else:
        raise RuntimeError("components did not settle")
    stars = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    hubs = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.union(hubs)
