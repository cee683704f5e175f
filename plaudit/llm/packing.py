"""Pack token sequences into bins of a fixed length by swap-based local search.

Documents longer than a bin are cut into full pieces with a shorter first one;
a full piece is a bin by itself. The other pieces are spread over blocks of
about ``BLOCK_ROWS`` and each block is packed in one task: best fit in
decreasing length gives the first bins, then the local search takes the emptiest
bins apart: a piece moves into a bin with room, or is exchanged one for one or
two for one with shorter pieces of a fuller bin, whenever that raises the sum
of squared fills, until bins are empty or nothing improves. A block wastes at
most about a bin, so the total is near the bound ``tokens / bin length``.

Token ids come from a tokenizer file. Distinct stretches of text that the
tokenizer's splitting rule keeps apart are encoded once per batch and worker
(see :class:`ChunkEncoder`), then put together with array operations.

Null texts count as empty; an empty document is the closing id alone. Very long
texts are encoded a few million characters at a time. Repeated rows become
pieces each. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.llm.common import cut

BIN = 2_048
BLOCK_ROWS = 20_000
BATCH_CHARS = 1_000_000
WINDOW_CHARS = 100_000
CACHE_CHUNKS = 1_500_000
TOKENIZER = "byte_bpe_50k.json"
# Classes of code points: letters, digits, white space, other; and those past
# the blocks below, whose class is left to the tokenizer.
_LETTER, _DIGIT, _SPACE, _OTHER, _OPEN = 0, 1, 2, 3, 4
_KNOWN = 0x250


def _classes() -> np.ndarray:
    out = np.full(_KNOWN + 1, _OTHER, dtype=np.uint8)
    for cp in range(_KNOWN):
        c = chr(cp)
        if c.isalpha():
            out[cp] = _LETTER
        elif c.isnumeric():
            out[cp] = _DIGIT
        elif c.isspace():
            out[cp] = _SPACE
    # Separators that languages' \s classes disagree on, and the soft cases.
    out[[0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0]] = _OPEN
    out[_KNOWN] = _OPEN
    return out


CLASSES = _classes()


def chunk_starts(cps: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Places where the splitting rule of the byte-level vocabulary (runs of
    letters, digits, other marks, each with one blank before it; contractions;
    white space) surely begins a new piece, whatever stands around them."""
    n = len(cps)
    cls = CLASSES[np.minimum(cps, _KNOWN)]
    a, b = cls[:-1], cls[1:]
    left = cps[:-1]
    known = (a != _OPEN) & (b != _OPEN)
    first_doc = np.zeros(n, dtype=bool)
    first_doc[doc_starts] = True
    lone = np.ones(n - 1, dtype=bool)  # the character before a[i] is no white space
    lone[1:] = (cls[:-2] != _SPACE) & (cls[:-2] != _OPEN)
    lone[first_doc[:-1]] = True
    begins = known & (a != b)
    begins &= ~((a == _SPACE) & ((left == 32) | ~lone))
    begins &= ~((a == _OTHER) & (b == _LETTER) & (left == 39))
    out = first_doc
    out[1:] |= begins
    return np.flatnonzero(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of non-empty ``texts``, one after another, begin, and their
    keys: a 64-bit multilinear hash of their code points and their length."""
    joined = "".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    doc_starts = np.cumsum(lengths) - lengths
    starts = chunk_starts(cps, doc_starts) if len(cps) > 1 else np.zeros(1, np.int64)
    width = np.diff(np.append(starts, len(cps)))
    place = np.arange(len(cps)) - np.repeat(starts, width)
    salt = _mix(np.arange(int(width.max()), dtype=np.uint64))
    keys = np.add.reduceat((cps + np.uint64(1)) * salt[place], starts)
    return starts, _mix(keys ^ (width.astype(np.uint64) << np.uint64(40)))


class ChunkEncoder:
    """Token ids of many texts, each distinct chunk encoded once.

    Chunks are told apart by their keys (see :func:`text_chunks`), found for about
    ``WINDOW_CHARS`` characters at a time: their arrays take some 60 bytes a
    character, the rest of a batch a few. The store starts anew where it would outgrow ``limit`` chunks.
    """

    def __init__(self, path: str, limit: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.tokenizer.encode_special_tokens = True
        self._clear()

    def _clear(self) -> None:
        self.keys, self.ids = np.zeros(0, np.uint64), array("I")
        self.at, self.size = np.zeros(0, np.uint32), np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, chunks: Iterable[str]) -> None:
        # One at a time: an encoding is far larger than its ids, and a task is one thread.
        at, size = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint32)
        for i, chunk in enumerate(chunks):
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            at[i], size[i] = len(self.ids), len(ids)
            self.ids.extend(ids)
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.at, self.size = np.insert(self.at, place, at), np.insert(self.size, place, size)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        full = np.flatnonzero(lengths)
        if not len(full):
            return out
        some = [texts[i] for i in full]
        joined = "".join(some)
        ends = np.cumsum(lengths[full])
        doc_starts = ends - lengths[full]
        parts = [(a, *text_chunks(some[a:b])) for a, b in batches_of(some, WINDOW_CHARS)]
        starts = np.concatenate([doc_starts[a] + own for a, own, _ in parts])
        keys = np.concatenate([k for _, _, k in parts])
        del parts
        width = np.diff(np.append(starts, len(joined)))
        unique, first, back = np.unique(keys, return_index=True, return_inverse=True)
        known = np.searchsorted(self.keys, unique)
        have = np.zeros(len(unique), bool)
        inside = known < len(self.keys)
        have[inside] = self.keys[known[inside]] == unique[inside]
        if not have.all():
            if len(self.keys) + int((~have).sum()) > self.limit:  # start anew with this batch
                self._clear()
                have[:] = False
            new = first[~have]
            self._learn(
                unique[~have], (joined[s : s + w] for s, w in zip(starts[new].tolist(), width[new].tolist(), strict=True))
            )
            known = np.searchsorted(self.keys, unique)
        at, size = (x[known][back].astype(np.int64) for x in (self.at, self.size))
        ends = np.cumsum(size)
        ids = np.frombuffer(self.ids, np.uint32)[np.repeat(at - (ends - size), size) + np.arange(int(ends[-1]))]
        per_doc = np.add.reduceat(size, np.searchsorted(starts, doc_starts))
        stops = np.cumsum(per_doc)
        for i, stop, m in zip(full, stops, per_doc, strict=True):
            out[i] = ids[stop - m : stop]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def batches_of(texts: list[str], chars: int):
    """Runs of texts of about ``chars`` characters."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield start, i
            start, total = i, 0
        total += len(t)
    yield start, len(texts)


def cut_lengths(n: int, size: int = BIN) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces; the first may be shorter."""
    if n <= size:
        return [(0, n)]
    first = n % size or size
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = BIN, end: int = 0,
                 tokenizer: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document."""
    kind = docs.schema[key].dataType.simpleString()

    def cut_up(batches):
        encode = encoder(tokenizer or tokenizer_path())
        tail = np.array([end], np.uint32)
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            keys = pdf["id"].tolist()
            for a, b in batches_of(texts, BATCH_CHARS):
                rows = []
                for k, ids in zip(keys[a:b], encode.encode(texts[a:b]), strict=True):
                    ids = np.concatenate([ids, tail])
                    rows += [
                        (k, p, s, m, zlib.crc32(ids[s : s + m].astype("<u4").tobytes()))
                        for p, (s, m) in enumerate(cut_lengths(len(ids), size))
                    ]
                out = pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32"])
                out["id"] = pd.array(out["id"], dtype="Int64") if kind == "bigint" else out["id"]
                yield out

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInPandas(
        cut_up, f"id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, into the fullest bin with room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(room, (lengths[i], -1))
        if at == len(room):
            bins.append([i])
            left, b = size - lengths[i], len(bins) - 1
        else:
            left, b = room.pop(at)
            bins[b].append(i)
            left -= lengths[i]
        if left:
            insort(room, (left, b))
    return bins


def local_search(bins: list[list[int]], lengths: list[int], size: int, rounds: int = 4) -> list[list[int]]:
    """Empty underfull bins: move a piece, or exchange it for one or two shorter
    pieces of a bin that is then fuller; every step raises the squared fills.

    Emptiest bins give first. A giver that cannot be emptied keeps what is left.
    """
    bins = [list(b) for b in bins]
    fill = [sum(lengths[i] for i in b) for b in bins]
    for _ in range(rounds):
        givers = [b for b in sorted(range(len(bins)), key=lambda b: fill[b]) if bins[b] and fill[b] < size]
        room = sorted((size - fill[b], b) for b in givers)
        changed = False
        for g in givers[: max(8, len(givers) // 2)]:
            if not bins[g] or fill[g] == size:
                continue
            for i in sorted(bins[g], key=lambda i: -lengths[i]):
                step = _better(g, i, bins, fill, lengths, size, room)
                if step is None:
                    continue
                to, back = step
                for b in (g, to):
                    at = bisect_left(room, (size - fill[b], b))
                    if at < len(room) and room[at] == (size - fill[b], b):
                        room.pop(at)
                bins[g].remove(i)
                bins[to].append(i)
                for j in back:
                    bins[to].remove(j)
                    bins[g].append(j)
                moved = lengths[i] - sum(lengths[j] for j in back)
                fill[to] += moved
                fill[g] -= moved
                for b in (g, to):
                    if bins[b] and fill[b] < size:
                        insort(room, (size - fill[b], b))
                changed = True
        if not changed:
            break
    return [b for b in bins if b]


def _better(g, i, bins, fill, lengths, size, room, tries: int = 48):
    """The first improving step for piece ``i`` of bin ``g``: ``(bin, pieces back)``.

    With ``d`` the net length that moves, squared fills rise iff
    ``fill[to] + d > fill[g]``.
    """
    a = lengths[i]
    at = bisect_left(room, (a, -1))
    for space, to in room[at : at + tries]:  # a move
        if to != g and fill[to] + a > fill[g]:
            return to, []
    low = bisect_left(room, (1, -1))
    for space, to in room[low : low + tries]:  # an exchange into the fullest bins
        if to == g:
            continue
        own = sorted((lengths[j], j) for j in bins[to] if lengths[j] < a)
        for x, j in own:
            if a - x <= space and fill[to] + a - x > fill[g]:
                return to, [j]
        for m, (x, j) in enumerate(own):
            for y, k in own[m + 1 :]:
                if 0 < a - x - y <= space and fill[to] + a - x - y > fill[g]:
                    return to, [j, k]
    return None


def pack_lengths(lengths: list[int], size: int = BIN) -> list[list[int]]:
    return local_search(best_fit(lengths, size), lengths, size)


def pack_pieces(pieces: DataFrame, size: int = BIN, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces.

    Rows are told apart by their place in the written table, so repeated rows
    are packed like others and no block outgrows its share.
    """
    rows = pieces.where(F.col("length") < size).count()
    blocks = max(1, -(-rows // block_rows))
    numbered = pieces.withColumn("__n", F.monotonically_increasing_id())
    full = numbered.where(F.col("length") >= size).select(
        *pieces.columns, (-F.col("__n") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    schema = full.schema

    def pack(key, pdf):
        pdf = pdf.sort_values("__n", ignore_index=True)
        lengths = pdf["length"].tolist()
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for s, b in enumerate(pack_lengths(lengths, size)):
            used = 0
            for i in b:
                sequence[i], offset[i] = int(key[0]) * (1 << 32) + s, used
                used += lengths[i]
        return pdf.assign(sequence_id=sequence, offset=offset)[schema.names]

    some = numbered.where(F.col("length") < size).withColumn(
        "__block", F.pmod(F.xxhash64("__n"), F.lit(blocks)).cast("long")
    )
    return full.unionByName(some.groupBy("__block").applyInPandas(pack, schema))


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = BIN) -> DataFrame:
    pieces = cut(token_pieces(docs, key, text, size))
    return pack_pieces(pieces, size).withColumnRenamed("id", key)


__all__ = ["ChunkEncoder", "chunk_starts", "token_pieces", "pack_lengths", "pack_pieces", "pack_documents"]
