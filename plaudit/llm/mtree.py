"""Exact top-k inner products by best-first search in an M-tree.

Components become integers ``floor(scale * x)``. With ``M`` the largest squared
norm, the point ``(x, sqrt(M - |x|^2))`` lies at squared distance
``|q|^2 + M - 2 q.x`` from ``(q, 0)``: the nearest points have the largest inner
products, so a metric tree serves the search exactly (Ciaccia et al., 1997).

Index. Rows go to the nearest of at most ``PIVOTS`` routing points (the first
distinct rows by hash: the only sampled part, and every row is indexed); regions
above ``NODE_ROWS`` rows are split by hash. Each node is built in one task and
written as pages of about ``PAGE_ROWS`` entries, with covering radii and the
distance of every page and entry to its parent. Of equal vectors only the
``k + 1`` smallest ids can appear in a result, and only these are kept in pages.

Search. Query blocks meet groups of nodes (all queries against all rows, in
blocks). For each query nodes and pages are opened in the order of their lower
bounds until the bound passes the k-th best score found so far; stored parent
distances rule out pages and entries before their distance is computed. The
results of all groups are merged by a ranking window.

Vectors that are null, empty or hold null or non-finite components take no part;
shorter vectors count as padded with zeros. Fewer than ``k`` candidates give
fewer rows, an empty table none. Rows that repeat an id are candidates each; of
queries that repeat an id the smallest vector asks; queries leave out candidates
of their own id. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plaudit.llm.common import cut

PIVOTS = 256
NODE_ROWS = 4_096
PAGE_ROWS = 96
GROUP_NODES = 4
QUERY_ROWS = 512
SLACK = 1e-6


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _matrix(arrays, width: int) -> np.ndarray:
    out = np.zeros((len(arrays), width), dtype=np.float64)
    for i, a in enumerate(arrays):
        out[i, : len(a)] = a
    return out


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    last = np.sqrt(np.maximum(most - (x * x).sum(1), 0.0))
    return np.concatenate([x, last[:, None]], axis=1)


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers * centers).sum(1)[None, :] - 2 * x @ centers.T).argmin(1)


def _distances(x: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - center) ** 2).sum(1))


def _split(x: np.ndarray, rows: np.ndarray, page_rows: int) -> list[np.ndarray]:
    """Rows in pages of at most ``page_rows``: spread-out centers, nearest one
    each, again where a part is still too large."""
    if len(rows) <= page_rows:
        return [rows]
    n = min(len(rows), max(2, -(-len(rows) * 3 // (2 * page_rows))), 64)
    centers, far = [0], _distances(x[rows], x[rows[0]])
    while len(centers) < n and far.max() > 0:
        centers.append(int(far.argmax()))
        far = np.minimum(far, _distances(x[rows], x[rows[centers[-1]]]))
    if len(centers) == 1:  # all alike
        return [rows[i : i + page_rows] for i in range(0, len(rows), page_rows)]
    at = _nearest(x[rows], x[rows[centers]])
    return [p for c in range(len(centers)) if (at == c).any() for p in _split(x, rows[at == c], page_rows)]


def build_node(ids: np.ndarray, x: np.ndarray, most: float, page_rows: int = PAGE_ROWS) -> dict[str, np.ndarray]:
    """One routing node with its pages; ``x`` holds integers as doubles."""
    lifted = _lift(x, most)
    pages = _split(lifted, np.arange(len(ids)), page_rows)
    center = lifted.mean(0)
    page_center = np.array([lifted[p].mean(0) for p in pages])
    order = np.concatenate(pages)
    ends = np.cumsum([len(p) for p in pages])
    to_page = np.concatenate([_distances(lifted[p], c) for p, c in zip(pages, page_center, strict=True)])
    return {
        "center": center,
        "radius": _distances(lifted, center).max(keepdims=True),
        "page_center": page_center,
        "page_radius": np.array([_distances(lifted[p], c).max() for p, c in zip(pages, page_center, strict=True)]),
        "page_parent": _distances(page_center, center),
        "page_end": ends,
        "ids": ids[order],
        "x": x[order],
        "entry_parent": to_page,
    }


def search(nodes: list[dict], query_id: int, q: np.ndarray, most: float, k: int, floor: float = -np.inf):
    """The ``k`` best ``(score, id)`` of the nodes that can reach ``floor``."""
    base = float(q @ q) + most
    point = np.append(q, 0.0)
    best: list[tuple[float, int]] = []  # a heap: the worst first, ids negated
    limit = lambda: np.sqrt(max(base - 2 * max(floor, best[0][0] if len(best) == k else -np.inf), 0.0)) + SLACK
    queue: list[tuple[float, int, int, float]] = []
    for i, node in enumerate(nodes):
        d = float(np.sqrt(((node["center"] - point) ** 2).sum()))
        heapq.heappush(queue, (d - float(node["radius"][0]), i, -1, d))
    while queue:
        bound, i, p, d = heapq.heappop(queue)
        if bound > limit():
            break
        node = nodes[i]
        if p < 0:
            reach = limit()
            some = np.flatnonzero(np.abs(d - node["page_parent"]) - node["page_radius"] <= reach)
            dist = _distances(node["page_center"][some], point)
            low = dist - node["page_radius"][some]
            for j in np.flatnonzero(low <= reach):
                heapq.heappush(queue, (float(low[j]), i, int(some[j]), float(dist[j])))
            continue
        a, b = int(node["page_end"][p - 1]) if p else 0, int(node["page_end"][p])
        some = a + np.flatnonzero(np.abs(d - node["entry_parent"][a:b]) <= limit())
        scores = node["x"][some] @ q
        least = max(floor, best[0][0] if len(best) == k else -np.inf)
        for j in np.flatnonzero(scores >= least):
            at = int(node["ids"][some[j]])
            if at == query_id:
                continue
            item = (float(scores[j]), -at)
            if len(best) < k:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
    return [(s, -i) for s, i in best]


def _pack(node: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **(node | {"x": node["x"].astype(np.int32)}))
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as z:
        node = {name: z[name] for name in z.files}
    return node | {"x": node["x"].astype(np.float64)}


def build_tree(points: DataFrame, width: int, most: float, rows: int) -> DataFrame:
    """``points(id, v)`` as nodes ``(node long, pages binary)``."""
    n = max(1, min(PIVOTS, -(-rows // NODE_ROWS)))
    first = points.select("v").distinct().orderBy(F.xxhash64("v")).limit(n).toPandas()
    pivots = _lift(_matrix(first["v"].tolist(), width), most)

    def route(batches):
        for pdf in batches:
            if len(pdf):
                pdf["region"] = _nearest(_lift(_matrix(pdf["v"].tolist(), width), most), pivots)
                yield pdf

    routed = cut(points.mapInPandas(route, "id long, v array<bigint>, region long"))
    counts = routed.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / NODE_ROWS).alias("parts"))
    # One row per pivot: at most PIVOTS rows.
    parted = routed.join(F.broadcast(counts), "region").withColumn(
        "node", F.col("region") * F.lit(1 << 40) + F.pmod(F.xxhash64("id", "v"), F.col("parts"))
    )

    def build(key, pdf):
        pdf = pdf.sort_values("id", kind="stable")
        node = build_node(pdf["id"].to_numpy(np.int64), _matrix(pdf["v"].tolist(), width), most)
        return pd.DataFrame({"node": [int(key[0])], "pages": [_pack(node)]})

    return parted.select("node", "id", "v").groupBy("node").applyInPandas(build, "node long, pages binary")


def top_inner_products(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` best other rows."""
    good = usable(F.col(vector))
    points = cut(
        vectors.where(good & F.col(key).isNotNull()).select(
            F.col(key).cast("long").alias("id"), integers(F.col(vector), scale).alias("v"), is_query.alias("asks")
        )
    )
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    facts = points.agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("v")).alias("width"), F.max(norm).alias("most")
    ).first()
    spark = vectors.sparkSession
    if not facts["rows"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width, most, rows = facts["width"], float(facts["most"]), facts["rows"]
    alike = Window.partitionBy("v").orderBy("id")
    kept = points.select("id", "v").withColumn("n", F.row_number().over(alike)).where(F.col("n") <= k + 1).drop("n")
    nodes = cut(build_tree(kept, width, most, rows))
    n_nodes = nodes.count()
    queries = points.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    n_queries = queries.count()
    groups, blocks = max(1, -(-n_nodes // GROUP_NODES)), max(1, -(-n_queries // QUERY_ROWS))

    # A floor for every query's k-th score, from at most NODE_ROWS rows.
    probe = kept.orderBy(F.xxhash64("id", "v")).limit(min(NODE_ROWS, 1024)).toPandas()
    probe_ids, probe_x = probe["id"].to_numpy(np.int64), _matrix(probe["v"].tolist(), width)

    def seek(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            tree = [_unpack(p) for p in left["pages"]]
            q = _matrix(right["v"].tolist(), width)
            first = q @ probe_x.T
            first[right["id"].to_numpy()[:, None] == probe_ids[None, :]] = -np.inf
            floors = np.partition(first, -k, axis=1)[:, -k] if first.shape[1] >= k else np.full(len(q), -np.inf)
            for i, qid in enumerate(right["id"].tolist()):
                found += [(qid, s, at) for s, at in search(tree, qid, q[i], most, k, float(floors[i]))]
        ids, scores, at = zip(*found, strict=True) if found else ((), (), ())
        return pd.DataFrame(
            {"query_id": np.array(ids, np.int64), "vec_id": np.array(at, np.int64), "score": np.array(scores, np.int64)}
        )

    left = nodes.select(
        "pages",
        F.pmod(F.xxhash64("node"), F.lit(groups)).alias("g"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"),
    )
    right = queries.select(
        "id",
        "v",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"),
        F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("b"),
    )
    found = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInPandas(
        seek, "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
