"""Repeated byte strings across documents, found with suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id. Strings are judged on the input.

1. Anchors. Every window of ``LENGTH`` bytes holds the anchor where the hash of
   ``GRAM`` bytes is smallest, at the same place in equal windows. Only anchors
   that several documents hold can lie in a repeated window; they are counted by
   one aggregation.
2. Contexts. The surroundings of shared anchors that can lie in one window with
   them are dealt to tasks by anchor, with the bytes of equal ones once.
3. Suffix arrays. In a task, an anchor's contexts are cut to what they share with
   another of that anchor, and the distinct rest of each anchor becomes one string
   whose suffix array is built by linear grouping (``gsaca``). Suffixes that agree in
   ``LENGTH`` bytes are neighbours there; the smallest document of such a run
   decides for all of its places. Strings of many contexts are halved by window
   position first, down to single windows.
4. Documents. The runs of removed bytes meet the texts that have any, by document.

Equal texts are settled by their digests. Anchors that more than ``HOT`` documents
hold are dealt window by window and aggregated in the same way whatever their number, so no
task holds a common passage whole. Documents are told apart by their ids; a bitmap
that is bounded in size keeps other texts out of shuffles, and never decides.

Null texts are empty and lose nothing; rows with a null id lose nothing and take
nothing away; repeated rows with one id are the same document and take nothing from
each other; texts under ``LENGTH`` bytes are kept. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaudit.llm.common import cut, store, text_batches
from plaudit.llm.gsaca import suffix_arrays
from plaudit.llm.jaccard import mix64
from plaudit.llm.marks import Marks

LENGTH = 50
GRAM = 24
STRING_CONTEXTS = 12
TASK_CONTEXTS = 30_000
HOT = 1 << 16
HOT_ANCHORS = 1 << 20
CHUNK_BYTES = 250_000
SEEN_CONTEXTS = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Grams:
    """Hashes of all strings of one length, from sums over prefixes."""

    def __init__(self):
        self.up = self.back = np.zeros(0, np.uint64)

    def sums(self, b: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(b):
            self.up, self.back = _powers(_STEP, len(b) + 1), _powers(_BACK, len(b) + 1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b + np.uint64(1)) * self.up[: len(b)], out=total[1:])
        return total

    def hashes(self, total: np.ndarray, k: int) -> np.ndarray:
        """Of all strings of length ``k``."""
        return mix64((total[k:] - total[:-k]) * self.back[: len(total) - k])

    def spans(self, total: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the strings from ``begin`` to ``end``."""
        size = (end - begin).astype(np.uint64)
        return mix64((total[end] - total[begin]) * self.back[begin] ^ mix64(size))


_grams = Grams()


def _span_hashes(total: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _grams.spans(total, begin, end)


def _sliding(x: np.ndarray, w: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``w`` neighbours."""
    out, have = x, 1
    while have < w:
        more = min(have, w - have)
        out = best(out[: len(out) - more], out[more:])
        have += more
    return out


def anchors(raws: list[bytes], length: int = LENGTH, k: int = GRAM, total: np.ndarray | None = None):
    """``(text number, position, hash)`` of all anchors of some texts."""
    sizes = np.array([len(r) for r in raws], np.int64)
    if int(sizes.sum()) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if total is None:
        total = _grams.sums(np.frombuffer(b"".join(raws), np.uint8))
    starts = np.cumsum(sizes) - sizes
    h = _grams.hashes(total, k) | np.uint64(1)
    w = length - k + 1
    low = _sliding(h, w, np.minimum)  # of the window that starts here
    text = np.repeat(np.arange(len(raws)), sizes)
    at = np.arange(len(low))
    low[at + length > (starts + sizes)[text[: len(low)]]] = 0  # not within one text
    padded = np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
    p = np.flatnonzero(_sliding(padded, w, np.maximum) == h)
    return text[p], p - starts[text[p]], h[p]


def _chunks(texts: list[str | None]):
    """Runs of encoded texts of about ``CHUNK_BYTES``."""
    part: list[bytes] = []
    first, total = 0, 0
    for i, t in enumerate(texts):
        raw = (t or "").encode("utf-8", "surrogatepass")
        if part and total + len(raw) > CHUNK_BYTES:
            yield first, part
            part, first, total = [], i, 0
        part.append(raw)
        total += len(raw)
    if part:
        yield first, part


def _count_anchors(firsts: Marks):
    """Per batch: each anchor's number of distinct texts."""

    def run(batches):
        for pdf in batches:
            pdf = pdf.loc[firsts.has(pdf["bit"].to_numpy(np.int64))].drop_duplicates("text")
            found = [(first, *anchors(part)) for first, part in _chunks(pdf["text"].tolist())]
            if not found:
                continue
            h = np.concatenate([x[3] for x in found])
            d = np.concatenate([x[0] + x[1] for x in found])
            by = np.lexsort((d, h))
            h, d = h[by], d[by]
            one = np.ones(len(h), bool)
            one[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            seen, n = np.unique(h[one], return_counts=True)
            yield pd.DataFrame({"h": seen.view(np.int64), "n": n.astype(np.int64)})

    return run


def _digest(part: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True)


def _anchor_number(h):
    """A number below 2^63 for an anchor's hash; the same in Spark and here."""
    return F.shiftrightunsigned(h, 1) if isinstance(h, Column) else (h >> np.uint64(1)).astype(np.int64)


def _shared_anchors(pdf: pd.DataFrame, firsts: Marks, shared: Marks):
    """Ids, encoded texts, their prefix sums, text numbers, places and hashes, chunk
    by chunk."""
    pdf = pdf.loc[firsts.has(pdf["bit"].to_numpy(np.int64))]
    ids = pdf["id"].to_numpy(np.int64)
    for first, part in _chunks(pdf["text"].tolist()):
        total = _grams.sums(np.frombuffer(b"".join(part), np.uint8))
        text, at, h = anchors(part, total=total)
        keep = shared.has(_anchor_number(h) % shared.bits)
        yield ids[first : first + len(part)], part, total, text[keep], at[keep], h[keep]


def _is_hot(h: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(h), bool)
    return hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h


def _contexts(firsts: Marks, shared: Marks, hot: np.ndarray):
    """``(h, ctx, doc, anchor, places, body)``: the surroundings of shared anchors.
    One row holds all places of a context in a document, its bytes are in one row of a
    task, or in more if that has over ``SEEN_CONTEXTS``."""

    def run(batches):
        seen: set[int] = set()
        for pdf in batches:
            for ids, part, total, text, at, h in _shared_anchors(pdf, firsts, shared):
                cool = ~_is_hot(h, hot)
                text, at, h = text[cool], at[cool], h[cool]
                if not len(h):
                    continue
                sizes = np.array([len(r) for r in part], np.int64)
                starts = np.cumsum(sizes) - sizes
                low = np.maximum(0, at - (LENGTH - GRAM))
                high = np.minimum(at + LENGTH, sizes[text])
                ctx = _span_hashes(total, starts[text] + low, starts[text] + high) ^ mix64((at - low).astype(np.uint64))
                by = np.lexsort((low, text, ctx, h))
                text, at, h, low, high, ctx = text[by], at[by], h[by], low[by], high[by], ctx[by]
                other = (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1])
                first = np.flatnonzero(np.concatenate([[True], other | (text[1:] != text[:-1])]))
                fresh = np.concatenate([[True], other])[first]
                ends = np.append(first[1:], len(h))
                places = low.astype(np.int32).tobytes()
                names = mix64(h[first] ^ mix64(ctx[first])).tolist()
                body: list[bytes | None] = [None] * len(first)
                if len(seen) > SEEN_CONTEXTS:
                    seen.clear()
                for i in np.flatnonzero(fresh).tolist():
                    if names[i] not in seen:
                        seen.add(names[i])
                        j = first[i]
                        body[i] = part[text[j]][low[j] : high[j]]
                yield pd.DataFrame(
                    {
                        "h": h[first].view(np.int64),
                        "ctx": ctx[first].view(np.int64),
                        "doc": ids[text[first]],
                        "anchor": (at - low)[first].astype(np.int32),
                        "places": [places[4 * i : 4 * j] for i, j in zip(first.tolist(), ends.tolist(), strict=True)],
                        "body": body,
                    }
                )

    return run


def _hot_windows(firsts: Marks, shared: Marks, hot: np.ndarray):
    """``(key, doc, at)`` of every window that a hot anchor can stand for."""

    def run(batches):
        for pdf in batches:
            for ids, part, _, text, at, h in _shared_anchors(pdf, firsts, shared):
                warm = _is_hot(h, hot)
                rows: set[tuple[int, int]] = set()
                for t, p in zip(text[warm].tolist(), at[warm].tolist(), strict=True):
                    rows.update((t, s) for s in range(max(0, p - (LENGTH - GRAM)), min(p, len(part[t]) - LENGTH) + 1))
                listed = sorted(rows)
                yield pd.DataFrame(
                    {
                        "key": np.array([_digest(part[t][s : s + LENGTH]) for t, s in listed], np.int64),
                        "doc": ids[np.array([t for t, _ in listed], np.int64)],
                        "at": np.array([s for _, s in listed], np.int64),
                    }
                )

    return run


def _trim(bodies: np.ndarray, sizes: np.ndarray, anchor: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far each context agrees with another of its group, before and after the
    anchor; neighbours in sorted order agree the furthest."""
    n, wide, back = len(group), LENGTH, LENGTH - GRAM
    rows = np.arange(n)[:, None]
    after = anchor[:, None] + np.arange(wide)[None, :]
    right = np.where(after < sizes[:, None], bodies[rows, np.minimum(after, bodies.shape[1] - 1)], 0)
    before = anchor[:, None] - 1 - np.arange(back)[None, :]
    left = np.where(before >= 0, bodies[rows, np.maximum(before, 0)], 0)
    out = []
    for part, have in ((left, anchor), (right, sizes - anchor)):
        part = np.ascontiguousarray(part.astype(np.uint8))
        pad = np.zeros((n, -(-part.shape[1] // 8) * 8), np.uint8)
        pad[:, : part.shape[1]] = part
        words = pad.view(">u8")
        by = np.lexsort([*[words[:, i] for i in range(words.shape[1] - 1, -1, -1)], group])
        x = part[by]
        agree = np.where((x[1:] == x[:-1]).all(1), x.shape[1], (x[1:] != x[:-1]).argmax(1))
        agree = np.where(group[by][1:] == group[by][:-1], agree, 0)
        agree = np.minimum(agree, np.minimum(have[by][1:], have[by][:-1]))
        best = np.zeros(n, np.int64)
        best[by[1:]] = agree
        best[by[:-1]] = np.maximum(best[by[:-1]], agree)
        out.append(best)
    return out[0], out[1]


def _halves(items: list[tuple[int, int, int]], bodies: list[bytes], anchor: np.ndarray, low: int, high: int, most: int):
    """Strings of at most ``most`` contexts: slices ``(context, begin, end)`` that
    share a window ``q`` bytes before the anchor, ``low <= q <= high``."""
    if len(items) <= most or low == high:
        return [items]
    out, mid = [], (low + high) // 2
    for a, b in ((low, mid), (mid + 1, high)):
        parts: dict[bytes, list[tuple[int, int, int]]] = {}
        for c, begin, end in items:
            p = int(anchor[c])
            s, e = max(begin, p - b), min(end, p - a + LENGTH)
            if e - s >= LENGTH:
                parts.setdefault(bodies[c][max(p - a, s) : min(p - b + LENGTH, e)], []).append((c, s, e))
        for same in parts.values():
            if len(same) > 1:
                out += _halves(same, bodies, anchor, a, b, most)
    return out


def smallest_documents(bodies: list[bytes], anchor: np.ndarray, group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every window of every context the smallest document that holds its bytes.

    Contexts are distinct within their group, ``doc`` is the smallest document of
    each. Columns past a context's last window hold the largest number.
    """
    n, windows = len(bodies), LENGTH - GRAM + 1
    sizes = np.array([len(b) for b in bodies], np.int64)
    least = np.where(
        np.arange(windows)[None, :] <= (sizes - LENGTH)[:, None], doc[:, None], np.iinfo(np.int64).max
    )
    width = int(sizes.max())
    flat = np.frombuffer(b"".join(b.ljust(width, b"\0") for b in bodies), np.uint8).reshape(n, width)
    left, right = _trim(flat, sizes, anchor, group)
    near = np.flatnonzero(left + right >= LENGTH)
    strings: list[list[tuple[int, int, int]]] = []
    by_group: dict[int, list[tuple[int, int, int]]] = {}
    for c, g, s, e in zip(
        near.tolist(), group[near].tolist(), (anchor - left)[near].tolist(), (anchor + right)[near].tolist(), strict=True
    ):
        by_group.setdefault(g, []).append((c, s, e))
    for items in by_group.values():
        strings += _halves(items, bodies, anchor, 0, LENGTH - GRAM, STRING_CONTEXTS)
    # Equal slices stand in a string once, for all of their contexts.
    pieces: list[bytes] = []
    starts: list[int] = []
    owners: list[tuple[int, int, int]] = []
    ends: list[int] = []
    at = 0
    alone: list[tuple[int, int, int, int]] = []
    for items in strings:
        number: dict[bytes, int] = {}
        c, s, e = items[0]
        if all(bodies[d][x:y] == bodies[c][s:e] for d, x, y in items[1:]):
            lowest = min(int(doc[d]) for d, _, _ in items)
            alone += [(d, x, y - x - LENGTH + 1, lowest) for d, x, y in items]
            continue
        for c, s, e in items:
            b = bodies[c][s:e]
            if b not in number:
                number[b] = len(starts)
                pieces.append(b)
                starts.append(at)
                at += len(b) + 1
            owners.append((number[b], c, s))
        pieces.append(b"")
        ends.append(at)
        at += 1
    if alone:  # one slice for all contexts: no order is needed
        rows = np.array(alone, np.int64)
        n_alone = rows[:, 2]
        shift = np.arange(int(n_alone.sum())) - np.repeat(np.cumsum(n_alone) - n_alone, n_alone)
        places = (np.repeat(rows[:, 0], n_alone), np.repeat(rows[:, 1], n_alone) + shift)
        np.minimum.at(least, places, np.repeat(rows[:, 3], n_alone))
    if not starts:
        return least
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int32) + 2
    sizes = np.array([len(b) for b in pieces if b], np.int64)
    start = np.array(starts, np.int64)
    text[start + sizes] = 1  # after each slice
    text[ends] = 0  # after each string
    order = suffix_arrays(text, np.diff(np.concatenate([[-1], ends])))
    # The places of whole windows, in suffix order.
    n_windows = sizes - LENGTH + 1
    piece = np.full(len(text), -1, np.int32)
    shift = np.arange(int(n_windows.sum())) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    piece[np.repeat(start, n_windows) + shift] = np.repeat(np.arange(len(start)), n_windows)
    order = order[piece[order] >= 0].astype(np.int64)
    fresh = np.concatenate([[True], ~_agree(text, order)])
    run = np.cumsum(fresh) - 1
    owner = np.array(sorted(owners), np.int64)
    first = np.searchsorted(owner[:, 0], np.arange(len(start)))
    own = np.minimum.reduceat(doc[owner[:, 1]], first)
    smallest = np.empty(len(text), np.int64)
    smallest[order] = np.minimum.reduceat(own[piece[order]], np.flatnonzero(fresh))[run]
    # Back to the windows of all contexts that own a slice.
    n_own = n_windows[owner[:, 0]]
    shift = np.arange(int(n_own.sum())) - np.repeat(np.cumsum(n_own) - n_own, n_own)
    place = np.repeat(start[owner[:, 0]], n_own) + shift
    np.minimum.at(least, (np.repeat(owner[:, 1], n_own), np.repeat(owner[:, 2], n_own) + shift), smallest[place])
    return least


def _agree(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether neighbours in suffix order agree in ``LENGTH`` symbols."""
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    for i in range(LENGTH):
        some = np.flatnonzero(same)
        same[some] = text[order[some] + i] == text[order[some + 1] + i]
    return same


def merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each document with those that touch joined."""
    if not len(doc):
        return doc, begin, end
    by = np.lexsort((begin, doc))
    doc, begin, end = doc[by], begin[by], end[by]
    # Documents one after the other on a single axis.
    number = np.cumsum(np.concatenate([[True], doc[1:] != doc[:-1]])) - 1
    span = int(end.max()) + 2
    reach = np.maximum.accumulate(end + number * span)
    fresh = np.concatenate([[True], begin[1:] + number[1:] * span > reach[:-1]])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], begin[first], reach[last] - number[last] * span


def _removals(pdf: pd.DataFrame) -> pd.DataFrame:
    """The removed intervals that one task's anchors show."""
    keys = pdf[["h", "ctx"]].to_numpy(np.int64)
    by = np.lexsort((pdf["body"].isna().to_numpy(), keys[:, 1], keys[:, 0]))
    sorted_keys = keys[by]
    fresh = np.concatenate([[True], (sorted_keys[1:] != sorted_keys[:-1]).any(1)])
    at = np.empty(len(pdf), np.int64)
    at[by] = np.cumsum(fresh) - 1
    first = by[fresh]
    doc = pdf["doc"].to_numpy(np.int64)
    low = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(low, at, doc)
    bodies = pdf["body"].to_numpy()[first].tolist()
    anchor = pdf["anchor"].to_numpy(np.int64)[first]
    least = smallest_documents(bodies, anchor, keys[first, 0], low)
    cover = least[at] < doc[:, None]
    edge = np.diff(np.pad(cover, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    places = [np.frombuffer(x, np.int32) for x in pdf["places"]]
    many = np.array([len(x) for x in places], np.int64)
    every = np.concatenate(places).astype(np.int64)
    n = many[row]
    nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    place = every[np.repeat((np.cumsum(many) - many)[row], n) + nth]
    d, b, e = merged(
        np.repeat(doc[row], n), place + np.repeat(begin, n), place + np.repeat(end, n) - 1 + LENGTH
    )
    return pd.DataFrame({"doc": d, "b": b, "e": e})


def _edits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts and digest of what is left of the texts of one task."""
    texts = pdf.loc[pdf["text"].notna()].drop_duplicates("doc")
    spans = pdf.loc[pdf["text"].isna()]
    d, b, e = merged(spans["doc"].to_numpy(np.int64), spans["b"].to_numpy(np.int64), spans["e"].to_numpy(np.int64))
    rows = []
    for doc, text in zip(texts["doc"].tolist(), texts["text"].tolist(), strict=True):
        i, j = np.searchsorted(d, doc), np.searchsorted(d, doc, side="right")
        if i == j:
            continue
        raw = text.encode("utf-8", "surrogatepass")
        left, digest = 0, hashlib.sha256()
        for x, y in zip(b[i:j].tolist(), e[i:j].tolist(), strict=True):
            digest.update(raw[left:x])
            left = y
        digest.update(raw[left:])
        rows.append((doc, int((e[i:j] - b[i:j]).sum()), int(j - i), digest.hexdigest()))
    return pd.DataFrame(rows, columns=["doc", "n_removed", "n_spans", "kept_sha256"]).astype(
        {"doc": "int64", "n_removed": "int64", "n_spans": "int64"}
    )


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(id, n_bytes, whole, sha)`` of every row, ``whole`` if a smaller document
    has the same text; and the removed intervals ``(doc, b, e)`` of the other rows."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    facts = cut(
        rows.select(
            "id",
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.xxhash64("text").alias("t1"),
            F.xxhash64(F.lit(1), "text").alias("t2"),
            F.sha2("text", 256).alias("sha"),
        )
    )
    long = facts.where((F.col("n_bytes") >= LENGTH) & F.col("id").isNotNull())
    first = cut(long.groupBy("t1", "t2", "n_bytes").agg(F.min("id").alias("first")))
    base = facts.join(first, ["t1", "t2", "n_bytes"], "left").select(
        "id", "n_bytes", "sha", F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("whole")
    )
    firsts = Marks(first, F.xxhash64("first"), first.count())
    seen = rows.where((F.octet_length("text") >= LENGTH) & F.col("id").isNotNull()).withColumn(
        "bit", firsts.bit(F.xxhash64("id"))
    )
    counts = seen.mapInPandas(_count_anchors(firsts), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counts = store(counts.where("n > 1"), "anchors")
    size = counts.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("places")).first()
    shared = Marks(counts, _anchor_number(F.col("h")), size["rows"])
    often = counts.where(F.col("n") > max(HOT, size["places"] // HOT_ANCHORS)).select("h").toPandas()
    hot = np.sort(often["h"].to_numpy(np.int64).view(np.uint64))
    tasks = max(1, -(-size["places"] // TASK_CONTEXTS))
    contexts = seen.mapInPandas(
        _contexts(firsts, shared, hot), "h long, ctx long, doc long, anchor int, places binary, body binary"
    ).withColumn("task", F.pmod(F.xxhash64("h"), F.lit(tasks)))
    spans = contexts.groupBy("task").applyInPandas(_removals, "doc long, b long, e long")
    if len(hot):
        windows = store(
            seen.mapInPandas(_hot_windows(firsts, shared, hot), "key long, doc long, at long"), "windows"
        )
        low = cut(windows.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high"))
        late = windows.join(low, "key").where("doc > low")
        spans = spans.union(late.select("doc", F.col("at").alias("b"), (F.col("at") + LENGTH).alias("e")))
    return base, store(spans, "spans")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    with text_batches(docs.sparkSession):
        base, edits = _edited(docs, key, text)
    zero = F.lit(0).cast("long")
    out = base.join(edits.withColumnRenamed("doc", "id"), "id", "left")
    return out.select(
        F.col("id").alias(key),
        "n_bytes",
        F.when(F.col("whole"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(F.col("whole"), F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(F.col("whole"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def _edited(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The written facts of every row, and what is left of texts that lose a part."""
    base, spans = repeated_spans(docs, key, text)
    base = cut(base)
    concerned = spans.select("doc").distinct()
    n = concerned.count()
    marks = Marks(concerned, F.xxhash64("doc"), n)

    def keep(batches):
        for pdf in batches:
            yield pdf.loc[marks.has(pdf["bit"].to_numpy(np.int64)), ["doc", "text"]]

    texts = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), marks.bit(F.xxhash64(F.col(key).cast("long"))).alias("bit")
    )
    none = F.lit(None).cast("long")
    both = texts.mapInPandas(keep, "doc long, text string").select("doc", "text", none.alias("b"), none.alias("e")).union(
        spans.select("doc", F.lit(None).cast("string"), "b", "e")
    )
    tasks = max(1, -(-n // 400))
    edits = (
        both.withColumn("task", F.pmod(F.xxhash64("doc"), F.lit(tasks)))
        .groupBy("task")
        .applyInPandas(_edits, "doc long, n_removed long, n_spans long, kept_sha256 string")
    )
    return base, store(edits, "edits")
