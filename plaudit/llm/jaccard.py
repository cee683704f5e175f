"""Exact Jaccard join of documents as sets of word shingles, in metric space.

``d = 1 - Jaccard`` is a metric, and linked documents lie within
``eps = 1 - threshold``. Documents with equal sets are one point.

1. Regions. In one global order of shingles two linked sets share a shingle of their
   first ``n - ceil(threshold * n) + 1``. Every shingle of those prefixes makes a
   region of the points that hold it. The order begins with shingles whose documents
   are counted, rare ones first, so that a shared passage makes no large region of
   unlike documents, and those that one document holds make none. A first pass counts
   a part of all shingles, chosen by hash; a second one, among the points that have
   come into regions, counts all, which leaves out points whose other texts differ.
   Bitmaps of bounded size carry the counts; an error there changes the order for
   all documents alike, and any order gives the same links.
   A point's rest in a region are its shingles from that one on: two sets share no
   more than the smaller rest in the region of the first shingle they share, so pairs
   that would need more are left to no region.
2. Pivots. Each region's pivot is its most central point, the one with the least part
   of shingles that no other point holds; its distance to every point of the region
   that rests allow is computed exactly. Points within ``eps`` are linked to it: these
   are the Voronoi cells, and copies by the thousand join by one distance each.
3. Recursion. A region whose points lie in one component needs nothing more. The
   others take new pivots, round by round, for the points outside the pivot's
   component, while that saves comparisons. In what is left, points of different
   components are joined, one of them outside the pivot's: the smaller set goes to the
   band of its size, the larger one to all bands that its rest allows, and by the
   triangle inequality only where their distances to the pivot differ by at most
   ``eps``, rounding included.

Sets travel as compressed texts of the points concerned, in tasks of bounded size;
a large cell is split by hash, its pivot replicated. Before that, sizes prune by
``threshold * n <= m <= n / threshold`` and small sketches by an upper bound of the
intersection; points that these keep apart from their pivot have no distance to it, and
the triangle inequality says nothing of them.

Null, empty and blank texts have empty sets, link with nothing and are their own
component. Fewer words than a shingle make one shorter shingle. Repeated rows and
equal ids fall into one component with their like; null ids into the class of
their set. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from plaudit.llm.common import components, cut, store, text_batches
from plaudit.llm.marks import Marks

SHINGLE_WORDS = 5
PERCENT = 80
COUNTED = 4
LEVELS = (2, 8, 64)
# The bits of a shingle that the bitmaps are about: the first level has two of them.
SHIFTS = (1, 33, 1, 1)
ROUNDS = 2
LEAF_PAIRS = 64
TASK_PAIRS = 800
# Width of a band of sizes, as a power of their ratio.
BAND = 1.05
# Characters hashed at once: a worker's memory.
HASHED_CHARS = 250_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of lower-cased ``raw``, in order."""
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    solid = ~_BLANK[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    width = ends - starts
    picked = b[solid].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(width) - width
    place = np.arange(len(picked)) - np.repeat(first, width)
    salt = mix64(np.arange(int(width.max()), dtype=np.uint64))
    return mix64(np.add.reduceat(picked * salt[place], first) + width.astype(np.uint64))


def _joined(words: np.ndarray, k: int) -> np.ndarray:
    h = np.full(len(words) - k + 1, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        h = mix64(h * np.uint64(0x9FB21C651E98DF25) + words[j : len(words) - k + 1 + j])
    return h


def shingle_sets(texts: list[str | None], k: int = SHINGLE_WORDS, chars: int = HASHED_CHARS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; many short texts are
    hashed together."""
    raws = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
    out: list[np.ndarray] = []
    i = 0
    while i < len(raws):
        j, total = i, 0
        while j < len(raws) and (j == i or total + len(raws[j]) < chars):
            total += len(raws[j])
            j += 1
        part = raws[i:j]
        counts = np.array([len(r.split()) for r in part], np.int64)
        words = word_hashes(b"\n".join(part))
        ends = np.cumsum(counts)
        every = _joined(words, k) if len(words) >= k else np.zeros(0, np.uint64)
        for n, end in zip(counts, ends, strict=True):
            if n >= k:
                out.append(np.unique(every[end - n : end - k + 1]))
            elif n:
                out.append(_joined(words[end - n : end], int(n)))
            else:
                out.append(np.zeros(0, np.uint64))
        i = j
    return out


def _signature(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix64(mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(s))).view(np.int64)[0])


def sketch(s: np.ndarray) -> bytes:
    """Counts of a set's hashes in about a quarter as many cells, 255 for more."""
    bits = max(1, min(16, int(np.log2(max(len(s), 8) / 4))))
    cell = (mix64(s ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def most_common(a: bytes, b: bytes) -> int:
    """An upper bound of the intersection size: the sum over cells of the smaller
    count. The finer sketch is folded to the other's cells."""
    x, y = (np.frombuffer(z, np.uint8).astype(np.int64) for z in (a, b))
    x, y = (np.where(z == 255, 1 << 40, z) for z in (x, y))
    if len(x) < len(y):
        x, y = y, x
    return int(np.minimum(x.reshape(len(y), -1).sum(1), y).sum())


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _survey(k: int):
    """Per document: id, signature, size and sketch."""

    def run(batches):
        for pdf in batches:
            sets = shingle_sets(pdf["text"].tolist(), k)
            yield pd.DataFrame(
                {
                    "id": pd.array(pdf["id"], dtype="Int64"),
                    "sig": pd.array([_signature(s) if len(s) else None for s in sets], dtype="Int64"),
                    "n": [len(s) for s in sets],
                    "sketch": [sketch(s) for s in sets],
                }
            )

    return run


def _counted(h: np.ndarray, part: int) -> np.ndarray:
    return (h >> np.uint64(7)) % np.uint64(part) == 0


def _distinct_sets(batches, k: int, among: Marks | None):
    """Signatures and sets of a task's texts, each set once, only of ids in ``among``
    if that is given."""
    seen: set[int] = set()
    for pdf in batches:
        if among is not None:
            pdf = pdf.loc[among.has(pdf["bit"].to_numpy(np.int64))]
        found = []
        for s in shingle_sets(pdf["text"].tolist(), k):
            sig = _signature(s) if len(s) else 0
            if len(s) and sig not in seen:
                seen.add(sig)
                found.append((sig, s))
        yield found


def _levels(h: np.ndarray, sieves: list[Marks]) -> np.ndarray:
    """How many of ``LEVELS`` a shingle's count reaches. The first two sieves hold the
    same shingles by other bits, so that few lone ones pass."""
    level = np.zeros(len(h), np.int8)
    at = np.arange(len(h))
    for shift, marks in zip(SHIFTS, sieves, strict=True):
        at = at[marks.has((h[at] >> np.uint64(shift)).astype(np.int64) % marks.bits)]
        level[at] += 1
    return np.maximum(level - 1, 0)


def _count_shingles(k: int, part: int, among: Marks | None, known: tuple[int, list[Marks]] | None):
    """``(h, n)``: how many sets of a batch hold each counted shingle, without those that
    an earlier count, ``known``, has found in one set."""

    def run(batches):
        for found in _distinct_sets(batches, k, among):
            if found:
                every = np.concatenate([s for _, s in found])
                every = every[_counted(every, part)]
                if known is not None:
                    every = every[~_counted(every, known[0]) | (_levels(every, known[1]) > 0)]
                seen, times = np.unique(every, return_counts=True)
                yield pd.DataFrame({"h": seen.view(np.int64), "n": times.astype(np.int64)})

    return run


def _postings(k: int, percent: int, sieves: list[Marks], part: int, among: Marks | None):
    """``(h, sig, rest, lone)`` of all prefixes, without shingles that only one set holds.
    ``rest``: how many of the set's shingles follow in the order, this one included;
    ``lone``: how many of 10,000 only this set holds."""

    def run(batches):
        for found in _distinct_sets(batches, k, among):
            if not found:
                continue
            every = np.concatenate([s for _, s in found])
            levels, used = _levels(every, sieves), _counted(every, part)
            # The uncounted come before the most common of the counted.
            ranks = np.where(used, levels * 2, 2 * len(LEVELS) - 1).astype(np.int8)
            hs, ids, rests, lones = [], [], [], []
            end = 0
            for sig, s in found:
                start, end = end, end + len(s)
                level, counted, rank = levels[start:end], used[start:end], ranks[start:end]
                first = np.argsort(rank, kind="stable")[: prefix_length(len(s), percent)]
                at = np.flatnonzero((level[first] > 0) | ~counted[first])
                hs.append(s[first[at]])
                ids.append(np.full(len(at), sig, np.int64))
                rests.append(len(s) - at)
                lones.append(np.full(len(at), 10_000 * int((rank == 0).sum()) // len(s), np.int64))
            yield pd.DataFrame(
                {
                    "h": np.concatenate(hs).view(np.int64),
                    "sig": np.concatenate(ids),
                    "rest": np.concatenate(rests),
                    "lone": np.concatenate(lones),
                }
            )

    return run


def _overlaps(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """Exact intersection sizes of the points of one task with their pivots."""
    sets = shingle_sets([zlib.decompress(z).decode("utf-8", "surrogatepass") for z in pdf["body"]], k)
    keys = list(zip(pdf["pivot"].tolist(), pdf["salt"].tolist(), strict=True))
    pivot = {key: i for i, (key, r) in enumerate(zip(keys, pdf["role"], strict=True)) if r == 0}
    rows = []
    for i, (sig, key, r) in enumerate(zip(pdf["sig"].tolist(), keys, pdf["role"], strict=True)):
        if r == 1 and key in pivot:
            a, b = sets[i], sets[pivot[key]]
            small, large = (a, b) if len(a) < len(b) else (b, a)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            rows.append((sig, key[0], int((large[at] == small).sum())))
    return pd.DataFrame(rows, columns=["sig", "pivot", "both"]).astype("int64")


def overlaps(pairs: DataFrame, docs: DataFrame, reps: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """``both``, the intersection size, of every stored pair ``(sig, pivot)``.

    A pivot's points are dealt to tasks of about ``TASK_PAIRS`` pairs, the pivot's
    text to each of them. ``reps(id, sig)`` names a document for each point; of
    ``docs(id, text)`` only texts that a bitmap of those ids lets pass are shuffled.
    """
    per = cut(pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / TASK_PAIRS).alias("parts")))
    salted = pairs.join(per, "pivot").select("sig", "pivot", F.pmod(F.xxhash64("sig"), F.col("parts")).alias("salt"))
    n = pairs.count()
    tasks = max(1, -(-n // TASK_PAIRS))
    points = salted.select("sig", "pivot", "salt", F.lit(1).alias("role"))
    pivots = salted.select(F.col("pivot").alias("sig"), "pivot", "salt", F.lit(0).alias("role")).distinct()
    roles = store(points.union(pivots).join(reps.select("id", "sig"), "sig"), "roles")
    marks = Marks(roles.select("id").distinct(), F.xxhash64("id"), 2 * n)

    def keep(batches):
        for pdf in batches:
            pdf = pdf.loc[marks.has(pdf["bit"].to_numpy(np.int64))]
            packed = [zlib.compress(t.encode("utf-8", "surrogatepass"), 6) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "body": packed})

    seen = docs.where("id is not null and text is not null").withColumn("bit", marks.bit(F.xxhash64("id")))
    rows = seen.mapInPandas(keep, "id long, body binary").join(roles, "id")
    rows = rows.withColumn("task", F.pmod(F.xxhash64("pivot", "salt"), F.lit(tasks)))
    found = rows.groupBy("task").applyInPandas(lambda pdf: _overlaps(pdf, k), "sig long, pivot long, both long")
    return store(found.distinct(), "overlaps")


def plausible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(sig, pivot, n, m)`` whose sizes and sketches allow a link. Both
    bounds are exact: no link is lost, and few other texts have to travel."""

    @pandas_udf("boolean")
    def may_link(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        rows = zip(x, y, n.tolist(), m.tolist(), strict=True)
        return pd.Series([100 * c >= percent * (i + j - c) for c, i, j in ((most_common(a, b), i, j) for a, b, i, j in rows)])

    left = reps.select("sig", "n", "sketch")
    right = reps.select(F.col("sig").alias("pivot"), F.col("n").alias("m"), F.col("sketch").alias("sketch2"))
    sized = pairs.join(reps.select("sig", "n"), "sig").join(right.drop("sketch2"), "pivot")
    sized = sized.where(f"100 * least(n, m) >= {percent} * greatest(n, m)").select("sig", "pivot")
    both = sized.join(left, "sig").join(right, "pivot")
    return both.where(may_link("sketch", "sketch2", "n", "m")).select("sig", "pivot", "n", "m")


def jaccard_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every document."""
    with text_batches(docs.sparkSession):
        return _classes(docs, key, text, k, percent)


def _classes(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    points = store(rows.mapInPandas(_survey(k), "id long, sig long, n long, sketch binary"), "survey")
    reps = points.where("sig is not null").groupBy("sig").agg(
        F.min("id").alias("id"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
    )
    reps = store(reps, "reps")

    def find_regions(
        part: int, among: Marks | None, known: tuple[int, list[Marks]] | None
    ) -> tuple[DataFrame, tuple[int, list[Marks]]]:
        """``(h, sig, rest, pivot)`` of all regions with several points, and what is counted."""
        seen = rows.select("text")
        if among is not None:
            seen = rows.where("id is not null").select("text", among.bit(F.xxhash64("id")).alias("bit"))
        counts = seen.mapInPandas(_count_shingles(k, part, among, known), "h long, n long")
        counts = store(counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= LEVELS[0]), "counts")
        sieves = []
        for least, shift in zip((LEVELS[0], *LEVELS), SHIFTS, strict=True):
            some = counts.where(F.col("n") >= least)
            sieves.append(Marks(some, F.shiftrightunsigned("h", shift), some.count(), 12 if least == LEVELS[0] else 24))
        found = seen.mapInPandas(
            _postings(k, percent, sieves, part, among), "h long, sig long, rest long, lone long"
        )
        postings = store(found, "postings")
        central = F.col("lone") * F.lit(1 << 40) + F.pmod("sig", F.lit(1 << 40))
        pivots = postings.groupBy("h").agg(
            F.min("sig").alias("low"),
            F.max("sig").alias("top"),
            F.min_by("sig", central).alias("pivot"),
        )
        pivots = cut(pivots.where("low <> top").select("h", "pivot"))
        return store(postings.drop("lone").join(pivots, "h").distinct(), "regions"), (part, sieves)

    regions, known = find_regions(COUNTED, None, None)
    some = cut(regions.select("sig").distinct().join(reps, "sig").select("id"))
    regions, _ = find_regions(1, Marks(some, F.xxhash64("id"), some.count()), known)
    del known
    regions = store(regions.join(reps.select("sig", "n"), "sig"), "sized")
    linked = f"100 * both >= {percent} * (n + m - both)"
    # Sets of n and m shingles that link share this part of n + m, and no more than their rests.
    shared = f"{100 + percent} * least(rest, rest2) >= {percent} * (n + m)"

    def compared(pairs: DataFrame) -> DataFrame:
        """Stored exact intersections of the pairs that may link."""
        pairs = store(plausible(pairs, reps, percent), "pairs")
        found = overlaps(pairs.select("sig", "pivot"), rows, reps, k).join(pairs, ["sig", "pivot"])
        return cut(found)

    def edges(found: DataFrame) -> DataFrame:
        return found.where(linked).select(F.col("sig").alias("a"), F.col("pivot").alias("b"))

    tops = regions.where("sig = pivot").select("h", F.col("n").alias("m"), F.col("rest").alias("rest2"))
    to_pivot = regions.where("sig <> pivot").join(tops, "h").where(shared)
    near = compared(to_pivot.select("sig", "pivot").distinct())
    links = edges(near)
    found = cut(components(spark, links))
    away = near.select("sig", "pivot", (1 - F.col("both") / (F.col("n") + F.col("m") - F.col("both"))).alias("d"))
    eps = (100 - percent) / 100

    def parts() -> DataFrame:
        """Region members with their components, of regions with several."""
        of = found.withColumnRenamed("node", "sig")
        member = regions.join(of, "sig", "left").select(
            "h", "sig", "pivot", "rest", "n", F.coalesce("component", "sig").alias("c")
        )
        main = F.max(F.when(F.col("sig") == F.col("pivot"), F.col("c"))).alias("main")
        parted = member.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high"), main)
        return store(member.join(cut(parted.where("low <> high").select("h", "main")), "h"), "parted")

    def size_band(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / F.lit(math.log(BAND))).cast("int")

    def banded(member: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The smaller and the larger sets of the pairs that are left, by ``(h, band)``.

        Bands are doubled, so that points of the pivot's component only meet others:
        odd ones hold the smaller sets and the larger ones outside it, even ones the
        smaller sets outside it and the larger ones inside.
        """
        rows = member.where("sig <> pivot").withColumn("out", F.col("c") != F.col("main"))
        few = rows.where(f"{100 + percent} * rest >= {2 * percent} * n")
        few = few.withColumn("at", 2 * size_band(F.col("n")))
        few = few.withColumn("band", F.explode(F.expr("if(out, array(at, at + 1), array(at + 1))"))).drop("at")
        # Its partner's least and largest size.
        many = rows.withColumn("least", F.expr(f"({percent} * n + 99) div 100"))
        many = many.withColumn("most", F.expr(f"least(n, {100 + percent} * rest div {percent} - n)")).where("least <= most")
        reach = F.sequence(size_band(F.col("least")), size_band(F.col("most")))
        many = many.withColumn("at", F.explode(reach)).withColumn("band", F.expr("2 * at + int(out)"))
        return few, many.drop("least", "most", "at")

    member = parts()
    n_points = reps.count()
    for turn in range(ROUNDS + 1):
        few, many = (store(df, "banded") for df in banded(member))
        x = few.groupBy("h", "band").agg(F.count(F.lit(1)).alias("x"))
        y = many.groupBy("h", "band").agg(F.count(F.lit(1)).alias("y"))
        left_over = x.join(y, ["h", "band"]).agg(F.sum(F.col("x") * F.col("y"))).first()[0] or 0
        if left_over <= LEAF_PAIRS * n_points or turn == ROUNDS:
            break
        by = F.xxhash64(F.lit(turn), "sig")
        new = member.where("c <> main").groupBy("h").agg(
            F.min_by("sig", by).alias("next"),
            F.min_by("c", by).alias("nc"),
            F.min_by("rest", by).alias("rest2"),
            F.min_by("n", by).alias("m"),
        )
        again = member.join(cut(new), "h").where("c <> nc").where(shared)
        again = again.select(F.least("sig", "next").alias("sig"), F.greatest("sig", "next").alias("pivot")).distinct()
        links = cut(links.union(edges(compared(again))).distinct())
        found = cut(components(spark, links))
        member = parts()

    # Points that rests, sizes or sketches keep apart from their pivot have no distance.
    left = few.join(away, ["sig", "pivot"], "left").select("h", "band", "sig", "n", "c", "rest", "d")
    right = many.join(away, ["sig", "pivot"], "left").select(
        "h",
        "band",
        F.col("sig").alias("sig2"),
        F.col("n").alias("m"),
        F.col("c").alias("c2"),
        F.col("rest").alias("rest2"),
        F.col("d").alias("d2"),
    )
    again = (
        left.join(right, ["h", "band"])
        .where((F.col("c") != F.col("c2")) & (F.col("n") <= F.col("m")))
        .where(F.coalesce(F.abs(F.col("d") - F.col("d2")) <= eps + 1e-9, F.lit(True)))
        .where(f"100 * n >= {percent} * m")
        .where(shared)
        .select(F.least("sig", "sig2").alias("sig"), F.greatest("sig", "sig2").alias("pivot"))
        .distinct()
    )
    more = edges(compared(again))
    if not more.isEmpty():
        found = cut(components(spark, links.union(more)))

    whole = points.drop("sketch").join(found.withColumnRenamed("node", "sig"), "sig", "left").select(
        "id", "n", "sig", F.coalesce("component", "sig").alias("c")
    )
    low = whole.where("c is not null").groupBy("c").agg(F.min("id").alias("component_id"))
    return whole.join(low, "c", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
