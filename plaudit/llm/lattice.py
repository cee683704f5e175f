"""Near-duplicate embeddings by lattice hashing on E8 (Jegou et al., 2008).

Each of ``TABLES`` tables projects the unit vector to 8 dimensions by a random
Gaussian matrix and decodes it to the nearest point of the E8 lattice: its home
cell. Every vector also probes the ``PROBES`` neighbouring cells nearest to it.
Vectors that meet, one at home and one at home or probing, are compared by
cosine in double precision; pairs below the threshold never pass.

Equal vectors are one point with a multiplicity. A cell's points are dealt to
blocks of at most ``CELL_ROWS`` home and ``CELL_ROWS`` probing points, all pairs of
blocks are compared by matrix products, so a cell that holds a large part of all
rows is spread over tasks and nothing is dropped. Pairs are never written out:
a pair counts in the first table and cell that finds it (recomputed from the two
vectors), a task returns sums per point and a spanning forest of its links.

With the defaults a pair at cosine 0.9 exactly is found with probability about
0.98, closer ones more often (see the tests). Larger collections want
a larger ``scale`` and more tables.

Vectors that are null, empty, zero or hold null or non-finite components link with
nothing and are kept; shorter vectors count as padded with zeros. Rows that repeat an
id are rows each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.llm.common import components, cut, store

TABLES = 4
PROBES = 10
SCALE = 0.7
CELL_ROWS = 512
TASK_ROWS = 20_000


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest point of D8 (integers with an even sum) to each row."""
    r = np.rint(x)
    off = x - r
    odd = np.flatnonzero(r.sum(1).astype(np.int64) & 1)
    worst = np.abs(off).argmax(1)[odd]
    r[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8, the union of D8 and D8 shifted by 1/2."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(closer[:, None], a, b)


@lru_cache(maxsize=1)
def shortest_vectors() -> np.ndarray:
    """The 240 neighbours of the origin in E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = s, t
            out.append(v)
    out += [list(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


class LatticeTables:
    """Projections, shifts and cell keys of all tables, made from a seed."""

    def __init__(self, width: int, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.tables, self.probes = tables, probes
        self.matrix = rng.normal(size=(tables, width, 8)) * scale
        self.shift = rng.normal(size=(tables, 8))
        self.salt = rng.integers(1, 1 << 62, size=8, dtype=np.int64).astype(np.uint64) | np.uint64(1)

    def _keys(self, points: np.ndarray, table: int) -> np.ndarray:
        twice = np.rint(points * 2).astype(np.int64).astype(np.uint64)
        h = np.full(points.shape[:-1], np.uint64(table + 1), dtype=np.uint64)
        for i in range(8):
            h = (h ^ twice[..., i]) * self.salt[i]
            h = h ^ (h >> np.uint64(29))
        return h.view(np.int64)

    def cells(self, unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Home keys ``(n)`` and probed keys ``(n, probes)`` in one table."""
        y = unit @ self.matrix[table] + self.shift[table]
        home = nearest_e8(y)
        near = shortest_vectors()
        closeness = (y - home) @ near.T
        best = np.argpartition(-closeness, self.probes - 1, axis=1)[:, : self.probes]
        return self._keys(home, table), self._keys(home[:, None, :] + near[best], table)


def _matrix(packed, width: int) -> np.ndarray:
    out = np.zeros((len(packed), width), dtype=np.float64)
    for i, p in enumerate(packed):
        v = np.frombuffer(p, np.float64 if p[:1] == b"d" else np.float32, offset=4)
        out[i, : len(v)] = v
    return out


def _packed(v, kind: str) -> bytes:
    head = b"d   " if kind == "double" else b"f   "
    return head + np.asarray(v, np.float64 if kind == "double" else np.float32).tobytes()


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = top(x), top(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _compare(pdf: pd.DataFrame, hashing: LatticeTables, width: int, least: float) -> pd.DataFrame:
    """All blocks of one task: sums of links per point, and a forest of them."""
    ids, mult = pdf["id"].to_numpy(np.int64), pdf["mult"].to_numpy(np.int64)
    x = _matrix(pdf["v"].tolist(), width)
    norm = np.sqrt((x * x).sum(1))
    home = pdf["home"].to_numpy(bool)
    order = np.lexsort((pdf["pc"], pdf["hc"], pdf["cell"], pdf["t"]))
    keys = pdf[["t", "cell", "hc", "pc"]].to_numpy(np.int64)[order]
    starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])) if len(order) else []
    found = []
    for s, e in zip(starts, [*starts[1:], len(order)], strict=True):
        rows = order[s:e]
        h, q = rows[home[rows]], rows[~home[rows]]
        if len(h) and len(q):
            cos = (x[q] @ x[h].T) / (norm[q][:, None] * norm[h][None, :])
            i, j = np.nonzero((cos >= least) & (ids[q][:, None] != ids[h][None, :]))
            if len(i):
                found.append(np.stack([np.full(len(i), keys[s, 0]), q[i], h[j]]))
    if not found:
        return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
    t, q, h = np.concatenate(found, axis=1)
    used, back = np.unique(np.concatenate([q, h]), return_inverse=True)
    q_at, h_at = back[: len(q)], back[len(q) :]
    unit = _unit(x[used])
    first = np.ones(len(t), dtype=bool)
    for table in range(int(t.max()) + 1):
        homes, probes = hashing.cells(unit, table)
        same = homes[q_at] == homes[h_at]
        there = (probes[q_at] == homes[h_at][:, None]).any(1)
        back_too = (probes[h_at] == homes[q_at][:, None]).any(1)
        first &= ~((table < t) & (same | there | back_too))
        # Within a table a pair that both sides find counts once.
        first &= ~((table == t) & (same | back_too) & (ids[q] > ids[h]))
    q, h = q[first], h[first]
    who = np.concatenate([ids[q], ids[h]])
    worth = np.concatenate([mult[h], mult[q]])
    points, at = np.unique(who, return_inverse=True)
    sums = np.bincount(at, worth, len(points)).astype(np.int64) if len(points) else np.zeros(0, np.int64)
    links = _forest(ids[q], ids[h])
    out = pd.DataFrame({"a": points, "b": np.full(len(points), -1, np.int64), "n": sums})
    more = pd.DataFrame({"a": [p for p, _ in links], "b": [r for _, r in links], "n": [0] * len(links)}).astype("int64")
    return pd.concat([out, more], ignore_index=True)


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, key: str = "vec_id", vector: str = "embedding",
    tables: int = TABLES, probes: int = PROBES, scale: float = SCALE,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    spark = vectors.sparkSession
    kind = "double" if "double" in vectors.schema[vector].dataType.simpleString() else "float"
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    good = _usable(F.col("v"))
    keys = [F.when(good, F.xxhash64(F.lit(s), "v")).alias(f"k{s}") for s in (1, 2)]
    named = cut(rows.select("id", *keys, F.when(good, F.size("v")).alias("width")))
    classes = cut(
        named.where("k1 is not null").groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"))
    )
    width = named.agg(F.max("width")).first()[0] or 1
    hashing = LatticeTables(width, tables, probes, scale)

    def pack(batches):
        for pdf in batches:
            yield pd.DataFrame({"k1": pdf["k1"], "k2": pdf["k2"], "v": [_packed(v, kind) for v in pdf["v"]]})

    packed = rows.where(good).select("v", *keys).mapInPandas(pack, "k1 long, k2 long, v binary")
    points = store(
        packed.dropDuplicates(["k1", "k2"]).join(classes, ["k1", "k2"]).select(F.col("rep").alias("id"), "mult", "v"),
        "points",
    )

    def locate(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            unit = _unit(_matrix(pdf["v"].tolist(), width))
            ids = pdf["id"].to_numpy(np.int64)
            for t in range(tables):
                homes, probed = hashing.cells(unit, t)
                n, m = len(ids), probed.shape[1]
                yield pd.DataFrame(
                    {
                        "id": np.concatenate([ids, ids, np.repeat(ids, m)]),
                        "t": np.full(n * (2 + m), t, np.int32),
                        "cell": np.concatenate([homes, homes, probed.ravel()]),
                        "home": np.concatenate([np.ones(n, bool), np.zeros(n + n * m, bool)]),
                    }
                )

    places = store(
        points.select("id", "v").mapInPandas(locate, "id long, t int, cell long, home boolean"), "places"
    )
    count = places.groupBy("t", "cell").agg(
        F.count(F.when(F.col("home"), 1)).alias("homes"), F.count(F.when(~F.col("home"), 1)).alias("seekers")
    )
    # A point alone in its cell, unprobed, meets nobody.
    met = count.where("homes > 0 and seekers > 1").select(
        "t", "cell",
        F.ceil(F.col("homes") / CELL_ROWS).cast("int").alias("hcs"),
        F.ceil(F.col("seekers") / CELL_ROWS).cast("int").alias("pcs"),
    )
    dealt = places.join(met, ["t", "cell"])
    own = F.pmod(F.xxhash64("id"), F.when(F.col("home"), F.col("hcs")).otherwise(F.col("pcs"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("home"), F.col("pcs")).otherwise(F.col("hcs")) - 1))
    dealt = dealt.select("id", "t", "cell", "home", own.alias("own"), other.alias("other")).select(
        "id", "t", "cell", "home",
        F.when(F.col("home"), F.col("own")).otherwise(F.col("other")).alias("hc"),
        F.when(F.col("home"), F.col("other")).otherwise(F.col("own")).alias("pc"),
    )
    tasks = max(8, -(-places.count() // TASK_ROWS))
    dealt = dealt.join(points, "id").withColumn("task", F.pmod(F.xxhash64("t", "cell", "hc", "pc"), F.lit(tasks)))
    found = store(
        dealt.groupBy("task").applyInPandas(
            lambda pdf: _compare(pdf, hashing, width, threshold), "a long, b long, n long"
        ),
        "links",
    )
    links = found.where("b < 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    joined = components(spark, found.where("b >= 0").select("a", "b"))
    facts = cut(
        classes.join(links, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    )
    out = named.join(facts, ["k1", "k2"], "left")
    component = F.coalesce("c", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    return F.coalesce(v.isNotNull() & fine & some, F.lit(False))
