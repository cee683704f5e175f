"""The driver's Parquet tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Columnar scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def stream_table(spark: SparkSession, sf_dir: str, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """The table as a file stream, whether it is one file or a folder of part files.

    A stream's source must be a pattern or a folder; the pattern matches the
    table's own path only.
    """
    reader = spark.readStream.schema(load_table(spark, sf_dir, name).schema)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.parquet(f"{table_path(sf_dir, name)[:-1]}[t]")
