"""Hierarchical weighted hash tree: rows descend region, rack and shard levels.

At each level every child of the current node draws ``-ln(u) / weight`` with
``u`` a uniform hash of (key, level, child); the smallest draw wins, so a child
is chosen with probability weight / sum of weights. A draw depends on the key
and that child alone: changing a weight changes that child's draw only, so rows
move into or out of the subtree whose weight changed and nowhere else. A shard
that joins as a region of its own (:func:`grow`) takes rows only into itself.

Built-in column expressions only. Rows with a null key descend like any other
key; a null text has no bytes; an empty table gives an empty result; repeated
rows share a shard and get slots of their own; the input's other columns are
left out unless asked for, so clashing names do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.llm.common import small, uniform

SLOT_ROWS = 200_000


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def build_tree(shards: int, per_rack: int = 4, racks: int = 3) -> list[Leaf]:
    """``shards`` equal leaves: ``per_rack`` to a rack, ``racks`` to a region."""
    return [Leaf(s // (per_rack * racks), s // per_rack, s) for s in range(shards)]


def grow(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a new rack of a new region."""
    new = Leaf(max(x.region for x in tree) + 1, max(x.rack for x in tree) + 1, max(x.shard for x in tree) + 1, weight)
    return [*tree, new]


def reweigh(tree: list[Leaf], shard: int, weight: float) -> list[Leaf]:
    return [replace(x, weight=weight) if x.shard == shard else x for x in tree]


def _winner(key: Column, level: str, weights: dict[int, float]) -> Column:
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    draws = [
        F.struct((-F.log(uniform(key, F.lit(level), F.lit(c))) / F.lit(float(w))).alias("draw"), F.lit(c).alias("child"))
        for c, w in weights.items()
        if w > 0
    ]
    return F.least(*draws)["child"] if len(draws) > 1 else draws[0]["child"]


def _sums(leaves: list[Leaf], field: str) -> dict[int, float]:
    out: dict[int, float] = {}
    for x in leaves:
        out[getattr(x, field)] = out.get(getattr(x, field), 0.0) + x.weight
    return out


def _choose(by: Column, options: dict[int, Column]) -> Column:
    chosen = F.lit(None).cast("int")
    for value, column in options.items():
        chosen = F.when(by == value, column).otherwise(chosen)
    return chosen


def descend(df: DataFrame, key: str, tree: list[Leaf], out: str = "shard") -> DataFrame:
    """Add column ``out``: the leaf of ``tree`` that ``key`` comes to."""
    if not tree or any(x.weight < 0 for x in tree) or not any(x.weight > 0 for x in tree):
        raise ValueError("a tree needs leaves of weights above 0")
    tree = [x for x in tree if x.weight > 0]
    k, region, rack = F.col(key), f"__region_{out}", f"__rack_{out}"
    regions = _sums(tree, "region")
    racks = {r: _sums([x for x in tree if x.region == r], "rack") for r in regions}
    shards = {r: _sums([x for x in tree if x.rack == r], "shard") for r in _sums(tree, "rack")}
    df = df.withColumn(region, _winner(k, "region", regions))
    df = df.withColumn(rack, _choose(F.col(region), {r: _winner(k, "rack", w) for r, w in racks.items()}))
    df = df.withColumn(out, _choose(F.col(rack), {r: _winner(k, "shard", w) for r, w in shards.items()}))
    return df.drop(region, rack)


def number_slots(df: DataFrame, shard: str, order: list[str], rows: int, part_rows: int = SLOT_ROWS) -> DataFrame:
    """Add ``slot``: gapless from 0 in each shard, without one task per shard.

    A shard's rows are spread over hash parts of about ``part_rows`` rows;
    parts are counted first, and a part's rows are numbered from the sum of the
    parts before it.
    """
    parts = max(1, -(-rows // part_rows))
    df = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    counts = df.groupBy(shard, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    place = F.row_number().over(Window.partitionBy(shard, "__part").orderBy(*order))
    return (
        df.withColumn("__place", place)
        .join(small(offsets, parts * 1000), [shard, "__part"])
        .withColumn("slot", (F.col("__place") - 1 + F.col("__offset")).cast("long"))
        .drop("__part", "__place", "__offset")
    )


def shard_documents(docs: DataFrame, tree: list[Leaf], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes, check sums, shard, slot and the shard after one more has joined."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.count()
    placed = descend(descend(docs.select(key, text), key, tree), key, grow(tree), "grown_shard")
    placed = placed.select(
        key,
        (F.octet_length(body).cast("long") + 8).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "grown_shard",
    )
    return number_slots(placed, "shard", [key], rows).select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


__all__ = ["Leaf", "build_tree", "grow", "reweigh", "descend", "number_slots", "shard_documents"]
