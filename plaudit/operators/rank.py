"""SRT1/SRT2: a dense 1..n rank per scope without one task per scope.

``row_number()`` over ``Window.orderBy(...)`` (whole data set) or
``Window.partitionBy(scope)`` moves every row of a scope into one task, and
the kept categories of a scope are not bounded. The rank is computed the way
``RDD.zipWithIndex`` does it, in DataFrame form, whatever the size:

1. ``orderBy(scope…, keys…, category)`` — a range-partitioned global sort;
   the key is a total order, so the result does not depend on partitioning;
2. tag each row with its partition and a per-partition increasing id, and
   cut the lineage with a reliable ``checkpoint()`` so both following passes
   see the same partitions even if an executor is lost;
3. count rows per ``(partition, scope)`` — at most ``partitions + scopes``
   rows — and turn them into offsets with a running sum over partitions;
4. join the offsets back: ``rank = rows of the scope in earlier partitions
   + position inside this partition + 1``.

The range partitioning keeps every task's share near the average even when
one scope holds most rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.session import checkpoint_dir


def ordinal_rank(
    df: DataFrame,
    order: Sequence[Column],
    scope: Sequence[str] = (),
    name: str = "rank",
) -> DataFrame:
    """Add ``name`` (BIGINT, 1-based) ranking rows of each scope by ``order``.

    ``order`` must make the order total within a scope (end it with a unique
    column such as ``category``); ties would otherwise be ranked arbitrarily.
    """
    checkpoint_dir(df.sparkSession)  # fail early without a shared folder
    keys = [F.col(s).asc_nulls_first() for s in scope] + list(order)
    tagged = (
        df.orderBy(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    starts = tagged.groupBy("_part", *scope).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy(*scope).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = starts.select(
        *[F.col(s).alias(f"_o_{i}") for i, s in enumerate(scope)],
        F.col("_part").alias("_o_part"),
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    cond = [tagged["_part"] == offsets["_o_part"]] + [
        tagged[s].eqNullSafe(offsets[f"_o_{i}"]) for i, s in enumerate(scope)
    ]
    ranked = tagged.join(offsets, on=cond, how="inner").withColumn(
        name, F.col("_before") + F.col("_row") - F.col("_first") + 1
    )
    drop = ["_part", "_row", "_o_part", "_first", "_before"]
    drop += [f"_o_{i}" for i in range(len(scope))]
    return ranked.drop(*drop)
