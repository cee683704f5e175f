"""Source divergence audit: how far the words of each source stray from its language's.

1. A first pass over the texts counts, by language, the documents of each term; those in
   ``LEAST_DOCUMENTS`` and more are kept, sorted and numbered by language.
2. Runs of ``SHARD_TERMS`` consecutive kept terms become a minimal acyclic transducer each
   (``transducer.py``), built by one task; its ordinals are the terms' numbers.
3. A second pass streams the texts: a batch's terms, counted by language and source, go in
   sorted runs to the shard whose range they fall into, and its transducer recounts
   them by ordinal. Only the shards' first terms, one for ``SHARD_TERMS`` kept ones, reach the
   driver. Groups of runs are salted, so that a task sees about ``SALT_DOCUMENTS`` documents.
4. Probabilities are exact integers of 1e-9 (decimals where the product passes 64 bits).
   Pairs of sources are compared in blocks of ordinals and tiles of sources: a block
   holds at most about ``CELLS`` numbers and gives partial sums, added up by Spark.
   Terms of a group are ranked by value and ordinal, the first ``TERMS`` of each.

Null texts, languages and sources count as ''. Languages without kept terms give their
pairs with value 0 and no terms. Repeated rows are documents each. An empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.llm.common import store
from plaudit.llm.transducer import Transducer
from plaudit.operators.rank import ordinal_rank

LEAST_DOCUMENTS = 3
SHARD_TERMS = 50_000
SALT_DOCUMENTS = 100_000
TERMS = 200
TILE = 64
CELLS = 1 << 20
UNIT = 1_000_000_000
# Letters of ASCII, lower-cased, and every byte of other characters.
TERM = re.compile(rb"[a-z\x80-\xff]+")


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, A-Z lower-cased, as UTF-8."""
    return TERM.findall((text or "").encode().lower())


def _frame(rows: int, /, **columns) -> pd.DataFrame:
    """So many rows; text as plain objects, also where there are none."""

    def plain(v):
        return pd.Series([v] * rows if isinstance(v, str) else v, dtype=object) if isinstance(v, (str, list)) else v

    return pd.DataFrame({c: plain(v) for c, v in columns.items()})


def _documents(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    names = {"text": text, "lang": lang, "source": source}
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for n, c in names.items()])


def kept_terms(rows: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(lang, term, ordinal)``: terms in ``least`` documents of the language and more,
    numbered from 1 in UTF-8 order."""

    def count(batches):
        for pdf in batches:
            found = defaultdict(Counter)
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                found[lang].update(set(terms_of(text)))
            for lang, c in found.items():
                yield _frame(len(c), lang=lang, term=[t.decode() for t in c], n=np.array(list(c.values()), np.int64))

    counted = rows.select("lang", "text").mapInPandas(count, "lang string, term string, n long")
    often = counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return store(ordinal_rank(often.select("lang", "term"), [F.col("term")], ["lang"], "ordinal"), "kept-terms")


def transducers(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One transducer for each run of ``shard_terms`` kept terms of a language."""

    def build(key, pdf):
        terms = sorted(t.encode() for t in pdf["term"])
        return pd.DataFrame([{"lang": key[0], "shard": key[1], "first": terms[0], **Transducer.build(terms).dump()}])

    shard = ((F.col("ordinal") - 1) / shard_terms).cast("long")
    built = kept.withColumn("shard", shard).groupBy("lang", "shard").applyInPandas(
        build,
        "lang string, shard long, first binary, width binary, byte binary, target binary, before binary, final binary",
    )
    return store(built, "transducers")


def recount(rows: DataFrame, built: DataFrame, shard_terms: int = SHARD_TERMS, salts: int = 1) -> DataFrame:
    """``(lang, source, ordinal, n)``: occurrences of the kept terms, none of them zero."""
    bounds = defaultdict(list)
    for r in built.select("lang", "shard", "first").orderBy("lang", "shard").toLocalIterator():
        bounds[r["lang"]].append(bytes(r["first"]))

    def route(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, pdf in enumerate(batches):
            found = defaultdict(Counter)
            for lang, source, text in zip(pdf["lang"], pdf["source"], pdf["text"], strict=True):
                if lang in bounds:
                    found[lang, source].update(terms_of(text))
            out = []
            for (lang, source), c in found.items():
                terms = sorted(c)
                cuts = [bisect_left(terms, b) for b in bounds[lang]] + [len(terms)]
                out += [
                    (lang, shard, (task + number) % salts, source, b"\n".join(terms[lo:hi]), [c[t] for t in terms[lo:hi]])
                    for shard, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
                    if hi > lo
                ]
            if out:
                yield pd.DataFrame(out, columns=["lang", "shard", "salt", "source", "run", "times"])

    runs = rows.mapInPandas(
        route, "lang string, shard long, salt long, source string, run binary, times array<long>"
    )
    # One copy of a transducer for every salt.
    salted = built.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    keys = ["lang", "shard", "salt"]

    def stream(key, left, right):
        lang, shard = key[0], key[1]
        if not len(left) or not len(right):
            none = np.zeros(0, np.int64)
            return _frame(0, lang="", source=[], ordinal=none, n=none)
        t = right.iloc[0]
        machine = Transducer.load(t["width"], t["byte"], t["target"], t["before"], t["final"])
        total = defaultdict(lambda: np.zeros(machine.size, np.int64))
        for source, run, times in zip(left["source"], left["run"], left["times"], strict=True):
            total[source] += machine.recount(run, np.asarray(times, np.int64))
        at = {source: np.flatnonzero(n) for source, n in total.items()}
        ordinal = np.concatenate([*at.values()]) + 1 + shard * shard_terms
        return _frame(
            len(ordinal), lang=lang, source=[s for s, places in at.items() for _ in places], ordinal=ordinal,
            n=np.concatenate([total[s][places] for s, places in at.items()]),
        )

    counted = runs.groupBy(keys).cogroup(salted.groupBy(keys)).applyInPandas(
        stream, "lang string, source string, ordinal long, n long"
    )
    return counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def share(count: Column, total: Column) -> Column:
    """``1 + floor(UNIT * (count + 1) / total)``, exactly."""
    product = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", product, total.cast("decimal(20,0)")) + 1


def _pair_values(cells: DataFrame, groups: DataFrame, sources: int) -> DataFrame:
    """``(lang, i, j, value)``: sums of ``f`` over all kept terms, of source i against j."""
    width = max(16, CELLS // max(1, sources))
    tiles = F.sequence(F.lit(0), F.lit((sources - 1) // TILE)).cast("array<bigint>")
    own = cells.select(
        "lang", "i", (F.col("ordinal") - 1).alias("at"), share(F.col("n"), F.col("total")).alias("p")
    ).withColumn("block", (F.col("at") / width).cast("long"))
    left = own.withColumn("tile", F.explode(tiles))
    blocks = F.sequence(F.lit(0).cast("long"), ((F.col("kept") - 1) / width).cast("long"))
    right = (
        groups.where("kept > 0")
        .select("lang", "i", "kept", share(F.lit(0).cast("long"), F.col("total")).alias("rest"), F.explode(blocks).alias("block"))
        .withColumn("tile", F.explode(tiles))
        .withColumnRenamed("i", "g")
    )
    keys = ["lang", "block", "tile"]

    def compare(key, a, b):
        lang, block, tile = key
        b = b.sort_values("g", ignore_index=True)
        n = len(b)
        columns = min(width, int(b["kept"].iloc[0]) - block * width)
        p = np.repeat(b["rest"].to_numpy(np.int64)[:, None], columns, axis=1)
        p[a["i"].to_numpy(np.int64), a["at"].to_numpy(np.int64) - block * width] = a["p"].to_numpy(np.int64)
        own = np.arange(tile * TILE, max(tile * TILE, min(n, (tile + 1) * TILE)))
        value = np.zeros((len(own), n), np.int64)
        for row, i in enumerate(own):
            apart = p[i] - p
            value[row] = (apart * apart // p).sum(axis=1)
        return _frame(
            value.size, lang=lang, i=np.repeat(own, n), j=np.tile(np.arange(n), len(own)), value=value.ravel()
        )

    partial = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(
        compare, "lang string, i long, j long, value long"
    )
    return partial.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS,
    top: int = TERMS, shard_terms: int = SHARD_TERMS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: every other source of the language
    (part ``pair``) and the ``top`` terms that the source overuses (part ``term``)."""
    rows = _documents(docs, text, lang, source)
    seen = store(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents")), "groups")
    size = seen.agg(F.sum("documents")).first()[0] or 0
    kept = kept_terms(rows, least)
    built = transducers(kept, shard_terms)
    cells = store(recount(rows, built, shard_terms, max(1, -(-size // SALT_DOCUMENTS))), "cells")

    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    words = cells.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    groups = store(
        seen.join(vocabulary, "lang", "left").join(words, ["lang", "source"], "left").select(
            "lang", "source", F.coalesce("kept", F.lit(0).cast("long")).alias("kept"),
            (F.coalesce("words", F.lit(0).cast("long")) + F.coalesce("kept", F.lit(0).cast("long"))).alias("total"),
            (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("i"),
        ),
        "group-totals",
    )
    whole = groups.groupBy("lang").agg(
        (F.sum(F.col("total") - F.col("kept")) + F.first("kept")).alias("lang_total")
    )
    named = cells.join(groups.drop("kept"), ["lang", "source"])

    of_group = Window.partitionBy("lang", "source")
    at_term = Window.partitionBy("lang", "ordinal")
    scored = (
        named.withColumn("lang_n", F.sum("n").over(at_term))
        .join(whole, "lang")
        .select(
            "lang", "source", "ordinal", share(F.col("n"), F.col("total")).alias("p"),
            share(F.col("lang_n"), F.col("lang_total")).alias("q"),
        )
        .where("p > q")
        .withColumn("value", F.expr("((p - q) * (p - q)) div q"))
    )
    ranked = scored.withColumn("rank", F.row_number().over(of_group.orderBy(F.desc("value"), "ordinal"))).where(
        F.col("rank") <= top
    )
    term_part = ranked.join(kept, ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )

    most = groups.agg(F.max("i")).first()[0] or 0
    values = _pair_values(named, groups, most + 1)
    other = groups.select("lang", F.col("source").alias("item"), F.col("i").alias("j"))
    pairs = (
        groups.select("lang", "source", "i").join(other, "lang").where("i <> j")
        .join(values, ["lang", "i", "j"], "left")
        .select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    )
    pair_part = pairs.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(of_group.orderBy(F.desc("value"), "item")).alias("rank"),
    )
    return pair_part.unionByName(term_part)
