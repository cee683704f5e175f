"""Mix sources to target weights by Pareto order sampling (Rosen, 1997).

A source's target is a number of words. ``target / source_size`` splits into
whole copies, which every document gets for certain, and a remainder that a
sample without replacement fills. A document's odds of inclusion are
``f / (1 - f) * (size / mean size) ** tilt`` with ``f`` the remainder's share;
documents are ranked by ``odds(u) / inclusion odds`` with ``u`` a uniform hash
of the document, and the sample is the ranking's head, of a fixed size in
words. The ranking is never sorted as a whole: documents fall into rank buckets
of about ``BUCKET_ROWS`` rows, whatever ``f`` and the sizes are; a source without a
remainder has none. In the others the buckets' word sums say which bucket holds
the end of the sample, and only that bucket is sorted and filled greedily. What is
then left, where a document is too long for it, is filled in the same way from the
later buckets, so no document that was left out would fit a source's target.

DataFrame operations only. Null texts have size 0, get odds of a one-word
document and add no words; null sources form a source of their own, the last;
an empty table gives an empty result; rows of a source that repeat a key share their hash
and are taken together; the input's other columns pass through, except
that names starting with ``__mix`` and the three output names are overwritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.llm.common import WORD, cut, small, uniform

BUCKET_ROWS = 2_000
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str, size: str, share: float, cap: float, weights=WEIGHTS) -> DataFrame:
    """One row per source: its size, rows and target words.

    Sources in code-point order (null last) weigh ``weights`` in turn and share
    ``share`` times all sizes; a target stops at ``cap`` times its source's size
    and the excess is shared again by weight. The final level is where the sum
    of ``min(weight * level, cap * size)`` is the total: sources are taken by
    the level at which they fill up, and the first one that stays below its cap
    fixes the level. The windows run over one aggregated row per source.
    """
    per = sizes.groupBy(source).agg(
        F.sum(size).cast("long").alias("source_size"), F.count(F.lit(1)).alias("__mix_rows")
    )
    order = Window.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    everything = Window.partitionBy()
    per = per.withColumn("__mix_w", weight).withColumn("__mix_cap", F.lit(float(cap)) * F.col("source_size"))
    per = per.withColumn("__mix_total", F.lit(float(share)) * F.sum("source_size").over(everything))
    fill = Window.orderBy(F.col("__mix_cap") / F.col("__mix_w"), F.col(source).asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    full = F.coalesce(F.sum("__mix_cap").over(before), F.lit(0.0))
    level = (F.col("__mix_total") - full) / F.sum("__mix_w").over(after)
    per = per.withColumn("__mix_level", level)
    open_ = F.when(F.col("__mix_level") * F.col("__mix_w") <= F.col("__mix_cap"), F.col("__mix_level"))
    per = per.withColumn("__mix_level", F.first(open_, ignorenulls=True).over(fill.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.coalesce(F.col("__mix_level") * F.col("__mix_w"), F.col("__mix_cap")), F.col("__mix_cap"))
    return per.select(source, "source_size", F.col("__mix_rows"), target.alias("target"))


def mix(
    docs: DataFrame,
    size: str,
    key: str = "doc_id",
    source: str = "source",
    share: float = 1.5,
    cap: float = 2.0,
    tilt: float = 0.5,
    weights=WEIGHTS,
    seed: int = 0,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``taken_copies``.

    ``taken_copies`` is how often the mix holds the row. ``docs`` is read three
    times (sizes, result by two paths), so pass a written table if its columns
    are costly.
    """
    docs = docs.drop("source_size", "target", "taken_copies")
    sizes = cut(docs.select(source, key, size))
    targets = source_targets(sizes, source, size, share, cap, weights).withColumnRenamed(source, "__mix_source")
    per = sizes.groupBy(F.col(source).alias("__mix_of"), _size_class(F.col(size)).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    per = per.groupBy("__mix_of").agg(F.sort_array(F.collect_list(F.struct("c", "n"))).alias("__mix_classes"))
    targets = cut(targets.join(per, F.col("__mix_source").eqNullSafe(F.col("__mix_of"))).drop("__mix_of"))
    n_sources = targets.count()
    rows = _ranked(docs, targets, n_sources, key, source, size, tilt, seed)
    heads, picked = _fill(_ranked(sizes, targets, n_sources, key, source, size, tilt, seed), key, size, n_sources)
    rows = rows.join(small(heads, n_sources), F.col("__mix_source").eqNullSafe(F.col("__mix_of")), "left").drop("__mix_of")
    at, words = F.col("__mix_bucket"), F.coalesce(F.col(size), F.lit(0))
    # Rounds after the first one take no empty texts.
    whole = F.exists(
        "__mix_heads",
        lambda h: (at >= h["start"]) & (at < h["end"]) & (words <= h["fit"]) & ((words > 0) | (h["start"] == 0)),
    )
    rows = rows.withColumn("__mix_head", F.coalesce(whole, F.lit(False)))
    inside = F.coalesce(F.exists("__mix_heads", lambda h: (at >= h["end"]) & (at < h["stop"])), F.lit(False))
    picked = picked.select(
        F.col("__mix_source").alias("__mix_of"), F.col(key).alias("__mix_key"), F.col(size).alias("__mix_size"),
        F.lit(1).alias("__mix_in"),
    )
    same = (
        F.col("__mix_source").eqNullSafe(F.col("__mix_of"))
        & F.col(key).eqNullSafe(F.col("__mix_key"))
        & (F.col(size) == F.col("__mix_size"))
    )
    near = rows.where(inside).join(picked, same, "left").withColumn("__mix_extra", F.coalesce("__mix_in", F.lit(0)))
    far = rows.where(~inside).withColumn("__mix_extra", F.col("__mix_head").cast("int"))
    out = far.unionByName(near.drop("__mix_of", "__mix_key", "__mix_size", "__mix_in"))
    out = out.withColumn("taken_copies", F.col("__mix_whole") + F.col("__mix_extra"))
    return out.select(*docs.columns, "source_size", "target", "taken_copies")


def _size_class(size: Column) -> Column:
    return F.floor(F.log2(F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)))).cast("int")


def _ranked(
    docs: DataFrame, targets: DataFrame, n_sources: int, key: str, source: str, size: str, tilt: float, seed: int
) -> DataFrame:
    """``docs`` with the whole copies, the words still wanted, the rank and its bucket.

    ``f / (1 - f)`` is the same for all documents of a source and changes no order,
    so the rank is ``u / (1 - u)`` over the tilt alone. A document of tilt ``c`` has a
    rank up to ``r`` with probability ``r c / (1 + r c)``; the mean of this over the
    source's documents, by classes of doubling sizes, is the share of documents up
    to ``r``. Buckets are equal steps of that share and hold about ``BUCKET_ROWS``
    rows whatever the remainder and the sizes.
    """
    share_of = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = docs.join(small(targets, n_sources), F.col(source).eqNullSafe(F.col("__mix_source")))
    rows = rows.withColumn("__mix_whole", F.floor(share_of).cast("int"))
    rows = rows.withColumn("__mix_want", F.col("target") - F.col("__mix_whole") * F.col("source_size"))
    u = uniform(F.col(key), F.lit(seed))
    mean = F.greatest(F.col("source_size") / F.col("__mix_rows"), F.lit(1.0))
    rows = rows.withColumn("__mix_mean", mean)
    rank = (u / (1 - u)) / F.pow(F.greatest(F.col(size), F.lit(1)) / F.col("__mix_mean"), F.lit(float(tilt)))
    rows = rows.withColumn("__mix_rank", rank)

    def upto(total: Column, c: Column) -> Column:
        odds = F.col("__mix_rank") * F.pow(F.pow(F.lit(2.0), c["c"] + 0.5) / F.col("__mix_mean"), F.lit(float(tilt)))
        return total + c["n"] * (odds / (1 + odds))

    before = F.aggregate("__mix_classes", F.lit(0.0), upto)
    last = F.greatest(F.ceil(F.col("__mix_rows") / BUCKET_ROWS), F.lit(1)) - 1
    steps = F.floor(before / F.col("__mix_rows") * (last + 1))
    return rows.withColumn("__mix_bucket", F.least(steps, last).cast("long")).drop("__mix_mean", "__mix_classes")


def _fill(rows: DataFrame, key: str, size: str, n_sources: int) -> tuple[DataFrame, DataFrame]:
    """Fill each source's want along its ranking, past documents that do not fit.

    Each round sums, by bucket, the documents no larger than the words left. All
    of them are taken up to the bucket in which the running sum passes the words
    left; that bucket, and the next ones while they hold ``BUCKET_ROWS`` such
    documents in all, are sorted and filled one document at a time. The next round
    starts behind them with what is then left, until no document fits. Returns
    ``(__mix_of, __mix_heads)``, per source an array of ``(start, end, stop, fit)``
    a round, and the ``(source, key, size)`` picked between ``end`` and ``stop``.
    """
    units = cut(rows.where("__mix_want > 0").select("__mix_source", key, size, "__mix_rank", "__mix_bucket", "__mix_want"))
    state = cut(units.groupBy("__mix_source").agg(F.max("__mix_want").alias("left")).select(
        F.col("__mix_source").alias("__mix_at"), F.lit(0).cast("long").alias("start"), F.col("left").cast("double")))
    units = units.drop("__mix_want")
    ends, picked = [], []
    by = Window.partitionBy("__mix_source").orderBy("__mix_bucket")
    of = F.col("__mix_source").eqNullSafe(F.col("__mix_at"))
    while True:
        now = units.join(small(state, n_sources), of).where(F.col("__mix_bucket") >= F.col("start"))
        if ends:
            now = now.where((F.col(size) > 0) & (F.col(size) <= F.col("left")))
        sums = now.groupBy("__mix_source", "__mix_bucket").agg(
            F.sum(size).alias("words"), F.count(F.lit(1)).alias("n"), F.max("left").alias("left"), F.max("start").alias("start")
        )
        upto = by.rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("words", F.coalesce("words", F.lit(0))).withColumn("before", F.sum("words").over(upto) - F.col("words"))
        sums = sums.withColumn("past", F.col("before") + F.col("words") > F.col("left"))
        # Documents in the buckets from the one with the cut on.
        sums = sums.withColumn("rest", F.sum(F.when(F.col("past"), F.col("n")).otherwise(0)).over(upto))
        first = F.min(F.when(F.col("past"), F.col("__mix_bucket")))
        fits = F.max(F.when(F.col("past") & (F.col("rest") <= BUCKET_ROWS), F.col("__mix_bucket")))
        end = sums.groupBy("__mix_source").agg(
            F.max("start").alias("start"),
            first.alias("end"),
            (F.greatest(fits, first) + 1).alias("stop"),
            F.max("left").alias("fit"),
            (F.max("left") - F.min(F.when(F.col("past"), F.col("before")))).alias("left"),
        )
        # Without a cut all that is left fits.
        never = F.lit((1 << 63) - 1).cast("long")
        end = end.withColumns({"end": F.coalesce("end", never), "stop": F.coalesce("stop", never)})
        end = cut(end.withColumnRenamed("__mix_source", "__mix_end_source"))
        if end.isEmpty():
            break
        ends.append(end.withColumn("round", F.lit(len(ends))))
        window = units.join(small(end, n_sources), F.col("__mix_source").eqNullSafe(F.col("__mix_end_source")))
        window = window.where("__mix_bucket >= end and __mix_bucket < stop").where(
            (F.col(size) > 0) & (F.col(size) <= F.col("left"))
        )
        # Rows that repeat key and size are taken together.
        window = window.groupBy("__mix_source", "__mix_bucket", "__mix_rank", key, size).agg(
            F.count(F.lit(1)).alias("n"), F.max("left").alias("left")
        )
        items = window.groupBy("__mix_source").agg(
            F.sort_array(F.collect_list(F.struct("__mix_bucket", "__mix_rank", F.col(key).alias("k"), F.col(size).alias("s"), "n"))).alias("items"),
            F.max("left").alias("left"),
        )
        taken = F.array().cast(f"array<struct<k:{_type(units, key)},s:{_type(units, size)}>>")
        done = F.aggregate(
            "items",
            F.struct(F.col("left").alias("left"), taken.alias("taken")),
            lambda acc, x: F.when(
                x["s"] * x["n"] <= acc["left"],
                F.struct(
                    (acc["left"] - x["s"] * x["n"]).alias("left"),
                    F.concat(acc["taken"], F.array(F.struct(x["k"].alias("k"), x["s"].alias("s")))).alias("taken"),
                ),
            ).otherwise(acc),
        )
        done = cut(items.select("__mix_source", done.alias("done")))
        picked.append(
            done.select("__mix_source", F.explode("done.taken").alias("x")).select(
                "__mix_source", F.col("x.k").alias(key), F.col("x.s").alias(size)
            )
        )
        after = done.select(F.col("__mix_source").alias("__mix_done"), F.col("done.left").alias("rest"))
        same = F.col("__mix_end_source").eqNullSafe(F.col("__mix_done"))
        state = cut(
            end.where(F.col("stop") < never).join(small(after, n_sources), same, "left").select(
                F.col("__mix_end_source").alias("__mix_at"), F.col("stop").alias("start"),
                F.coalesce("rest", "left").alias("left"),
            )
        )
    heads, chosen = None, None
    for e, p in zip(ends, picked, strict=True):
        e = e.select(F.col("__mix_end_source").alias("__mix_of"), F.struct("start", "end", "stop", "fit").alias("h"))
        heads, chosen = (e, p) if heads is None else (heads.union(e), chosen.union(p))
    if heads is None:
        none = "array<struct<start:bigint,end:bigint,stop:bigint,fit:double>>"
        heads = units.limit(0).select(F.col("__mix_source").alias("__mix_of"), F.array().cast(none).alias("__mix_heads"))
        return heads, units.limit(0).select("__mix_source", key, size)
    heads = cut(heads.groupBy("__mix_of").agg(F.collect_list("h").alias("__mix_heads")))
    return heads, cut(chosen.distinct())


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def mix_report(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Sizes, targets and words taken for every document."""
    sizes = cut(docs.select(key, source, word_count(F.col(text)).alias("size")))
    out = mix(sizes, "size", key, source)
    taken = (F.col("taken_copies") * F.col("size")).cast("long").alias("taken")
    return out.select(key, "size", "source_size", "target", taken)
