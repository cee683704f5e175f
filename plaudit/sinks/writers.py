"""SNK1, SNK3, SNK4: write or show a scorecard.

Order is data (the ``rank`` column), so readers never depend on file order;
``ordered=True`` still writes the part files in rank order (range-partitioned
sort), as a sorted text dump would be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("json", "parquet", "csv")


def write_scorecard(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    mode: str = "overwrite",
    scope: Sequence[str] = (),
    partition_by_scope: bool = False,
    ordered: bool = True,
    incremental: bool = False,
) -> None:
    """Write a scorecard; ``mode="overwrite"`` replaces an earlier result (SNK4).

    ``partition_by_scope`` writes one folder per batch / window, the layout of
    one output directory per interval. A full report replaces the whole output,
    so folders of an earlier run do not stay behind. ``incremental`` replaces
    only the folders of the scopes being written (dynamic partition overwrite):
    for reports of scopes that were not reported before. Rows go to tasks by
    ranges of scope and rank, which splits a large scope and keeps its files in
    rank order.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, got {fmt!r}")
    keys = [F.col(s).asc_nulls_first() for s in scope] + [F.col("rank")]
    out = df
    if ordered:
        out = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if scope else df.orderBy(*keys)
    writer = out.write.mode(mode).format(fmt)
    if partition_by_scope and scope:
        writer = writer.partitionBy(*scope).option(
            "partitionOverwriteMode", "dynamic" if incremental else "static"
        )
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)


def show_scorecard(df: DataFrame, scope: Sequence[str] = (), n: int = 20) -> None:
    """SNK3: print the first ``n`` rows in rank order (a console view)."""
    df.orderBy(*[F.col(s).asc_nulls_first() for s in scope], "rank").show(n, truncate=False)
