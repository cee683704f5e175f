"""Align the tokens of two tokenizers by products of sparse matrices.

A batch of texts, encoded twice, gives two token-byte incidence matrices in compressed
rows (:class:`Csr`): row i holds the bytes of token i. Their product ``A · Bᵀ``
(:func:`product`, Gustavson's row by row algorithm over whole blocks of rows) holds,
for every pair of overlapping tokens, the number of bytes they share: the *overlap
links*. Links whose ranges end together mark the common cuts, which split the tokens
into groups; ``G_A`` and ``G_B`` are the token-group incidence matrices, and
``G_A · G_Bᵀ`` holds the *shared-group links*. Its size alone needs no product
(:func:`product_sizes`); :func:`links` yields either kind, block by block.

The report counts each pair of ids over the whole corpus. Documents are aligned in blocks
of about ``BLOCK_CHARS`` characters, which keep their distinct pairs once; the counts of all blocks are
summed by pair, and the sums go back to a block's pairs by a join, so a pair that
stands in every document has one row a block, not one a document. A block and its
pairs are one task's group, bounded by its characters (and a document's own length).
The highest count of each id of B is broadcast: at most as many rows as B has ids.

A null or empty text, and one whose tokens' bytes do not spell a space and the text, has
no tokens: zeros and an empty digest. Repeated rows are aligned and counted each, also
those with a null id. Whole texts are encoded, whatever their length. An empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaudit.llm.common import store
from plaudit.llm.packing import batches_of, encoder, tokenizer_path

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
BATCH_CHARS = 1_000_000
BLOCK_CHARS = 4_000_000
# Entries of a product that one block of rows expands to.
BLOCK_ENTRIES = 1 << 22


@dataclass(frozen=True)
class Csr:
    """A sparse matrix in compressed rows."""

    start: np.ndarray  # of each row in ``column`` and ``value``, and their end
    column: np.ndarray
    value: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.start) - 1

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.start))

    def transposed(self) -> Csr:
        order = np.argsort(self.column, kind="stable")
        start = _starts(np.bincount(self.column, minlength=self.columns))
        return Csr(start, self.row_of_entry()[order], self.value[order], self.rows)


def _starts(widths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])


def byte_incidence(widths: np.ndarray) -> Csr:
    """Tokens by bytes: token i covers the next ``widths[i]`` bytes."""
    start = _starts(widths)
    n = int(start[-1])
    return Csr(start, np.arange(n), np.ones(n, np.int64), n)


def group_incidence(group: np.ndarray, groups: int) -> Csr:
    """Tokens by groups: each token lies in one."""
    return Csr(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Entries that each row of ``a · b`` expands to, before equal places are added."""
    return np.diff(_starts(np.diff(b.start)[a.column])[a.start])


def product_blocks(a: Csr, b: Csr, entries: int = BLOCK_ENTRIES) -> Iterator[tuple[int, Csr]]:
    """``a · b`` as ``(first row, block of rows)``: every entry (i, k) of ``a`` takes row k of
    ``b``, and entries of one place are added. A block expands to about ``entries``."""
    size = _starts(product_sizes(a, b))
    first = 0
    while first < a.rows:
        last = max(first + 1, int(np.searchsorted(size, size[first] + entries, "right")) - 1)
        lo, hi = a.start[first], a.start[last]
        k = a.column[lo:hi]
        width = b.start[k + 1] - b.start[k]
        offset = _starts(width)
        at = np.repeat(b.start[k] - offset[:-1], width) + np.arange(int(offset[-1]))
        row = np.repeat(np.repeat(np.arange(last - first), np.diff(a.start[first : last + 1])), width)
        place = row * b.columns + b.column[at]
        value = np.repeat(a.value[lo:hi], width) * b.value[at]
        if len(place) and (place[1:] < place[:-1]).any():
            order = np.argsort(place, kind="stable")
            place, value = place[order], value[order]
        new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else place
        value = np.add.reduceat(value, new) if len(new) else value
        place = place[new]
        start = _starts(np.bincount(place // max(1, b.columns), minlength=last - first))
        yield first, Csr(start, place % max(1, b.columns), value, b.columns)
        first = last


def product(a: Csr, b: Csr, entries: int = BLOCK_ENTRIES) -> Csr:
    blocks = [c for _, c in product_blocks(a, b, entries)]
    none = np.zeros(0, np.int64)
    return Csr(
        _starts(np.concatenate([none, *[np.diff(c.start) for c in blocks]])),
        np.concatenate([none, *[c.column for c in blocks]]),
        np.concatenate([none, *[c.value for c in blocks]]),
        b.columns,
    )


class Vocabulary:
    """The bytes of each id, joined: ids in, bytes out."""

    def __init__(self, pieces: list[bytes]):
        self.size = len(pieces)
        self.width = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.start = np.cumsum(self.width) - self.width
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The joined bytes and each token's width."""
        width = self.width[ids]
        offset = _starts(width)
        return self.bytes[np.repeat(self.start[ids] - offset[:-1], width) + np.arange(int(offset[-1]))], width


def _byte_level() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others from U+0100 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def byte_level_side(path: str) -> tuple[object, Vocabulary]:
    """The encoder of a byte-level tokenizer file and its ids' bytes."""
    encode = encoder(path)
    at = {i: p for p, i in encode.tokenizer.get_vocab(with_added_tokens=False).items()}
    byte = _byte_level()
    pieces = [bytes(byte[c] for c in at[i]) if i in at else b"" for i in range(max(at) + 1)]
    return encode, Vocabulary(pieces)


@lru_cache(maxsize=2)
def piece_side(path: str) -> tuple[object, Vocabulary]:
    """The encoder of a sentence-piece model file and its ids' bytes."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def spelled(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return model, Vocabulary([spelled(i) for i in range(model.get_piece_size())])


@dataclass(frozen=True)
class Aligned:
    """A batch's tokens that count, document by document, and their links."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    n_a: np.ndarray  # by document
    n_b: np.ndarray
    bytes_a: Csr
    bytes_b: Csr
    overlap: Csr
    groups_a: Csr
    groups_b: Csr
    cut_a: np.ndarray  # the token ends where one of the other side does
    cut_b: np.ndarray
    linked: tuple[np.ndarray, np.ndarray]  # tokens of the links that end together


def align_batch(texts: list[str | None], path_a: str, path_b: str) -> Aligned:
    encode_a, vocabulary_a = byte_level_side(path_a)
    model_b, vocabulary_b = piece_side(path_b)
    texts = [t or "" for t in texts]
    spaced = [" " + t if t else "" for t in texts]
    lists_a = encode_a.encode(spaced)
    lists_b = model_b.encode(texts, out_type=int, num_threads=1) if texts else []
    n_a = np.fromiter(map(len, lists_a), np.int64, len(texts))
    n_b = np.fromiter(map(len, lists_b), np.int64, len(texts))
    ids_a = np.concatenate([np.zeros(0, np.int64), *lists_a]).astype(np.int64)
    ids_b = np.fromiter(chain.from_iterable(lists_b), np.int64, int(n_b.sum()))
    whole = [t.encode() for t in spaced]
    for ids, n, vocabulary in ((ids_a, n_a, vocabulary_a), (ids_b, n_b, vocabulary_b)):
        spelt, width = vocabulary.spell(ids)
        end = np.cumsum(width)
        ends = np.concatenate([[0], end])[np.cumsum(n)].tolist()
        view, start = spelt.tobytes(), 0
        for i, stop in enumerate(ends):
            if view[start:stop] != whole[i]:
                whole[i] = b""  # spells something else: no tokens
            start = stop
    counts = np.array([len(w) > 0 for w in whole], bool)
    ids_a, ids_b = ids_a[np.repeat(counts, n_a)], ids_b[np.repeat(counts, n_b)]
    n_a, n_b = n_a * counts, n_b * counts

    a, b = byte_incidence(vocabulary_a.width[ids_a]), byte_incidence(vocabulary_b.width[ids_b])
    overlap = product(a, b.transposed())
    row = overlap.row_of_entry()
    together = a.start[1:][row] == b.start[1:][overlap.column]
    left, right = row[together], overlap.column[together]
    cut_a, cut_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    cut_a[left], cut_b[right] = True, True
    groups = int(cut_a.sum())
    return Aligned(
        ids_a, ids_b, n_a, n_b, a, b, overlap,
        group_incidence(np.cumsum(cut_a) - cut_a, groups), group_incidence(np.cumsum(cut_b) - cut_b, groups),
        cut_a, cut_b, (left, right),
    )


@lru_cache(maxsize=4)
def _written(size: int, mark: str) -> np.ndarray:
    """Each id in decimals, followed by ``mark``."""
    return np.array([f"{i}{mark}".encode() for i in range(size)], dtype=object)


def group_digests(x: Aligned, size_a: int, size_b: int) -> list[str]:
    """sha256 of ``a1,a2|b1;a3|b2,b3`` by document; '' without tokens."""
    by_group_a, by_group_b = np.diff(x.groups_a.transposed().start), np.diff(x.groups_b.transposed().start)
    before_b, upto_a = np.cumsum(by_group_b) - by_group_b, np.cumsum(by_group_a)
    parts = np.empty(len(x.ids_a) + len(x.ids_b), dtype=object)
    at_a = np.arange(len(x.ids_a)) + before_b[x.groups_a.column]
    at_b = np.arange(len(x.ids_b)) + upto_a[x.groups_b.column]
    parts[at_a] = np.where(x.cut_a, _written(size_a, "|")[x.ids_a], _written(size_a, ",")[x.ids_a])
    parts[at_b] = np.where(x.cut_b, _written(size_b, ";")[x.ids_b], _written(size_b, ",")[x.ids_b])
    ends = np.cumsum(x.n_a + x.n_b).tolist()
    out, start = [], 0
    for end in ends:
        out.append(hashlib.sha256(b"".join(parts[start:end].tolist())[:-1]).hexdigest() if end > start else "")
        start = end
    return out


def _per_document(values: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Sums of a value per token by document."""
    return np.diff(_starts(values)[_starts(tokens)])


def _block_schema(key: T.DataType) -> T.StructType:
    longs, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    return T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("keys", T.ArrayType(key)),
            *[T.StructField(c, longs) for c in ("n_a", "n_b", "n_links", "n_shared")],
            T.StructField("digests", T.ArrayType(T.StringType())),
            # The distinct pairs of each document: how many, which of the block's, how often.
            *[T.StructField(c, ints) for c in ("width", "which", "times")],
            # The distinct pairs of the block and their links in it.
            *[T.StructField(c, longs) for c in ("pairs", "counts")],
        ]
    )


def _blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each run of about ``BLOCK_CHARS`` characters of documents."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _block_schema(docs.schema["key"].dataType)
    arrow = to_arrow_schema(schema)

    def block(number: int, keys: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        size_a, size_b = byte_level_side(path_a)[1].size, piece_side(path_b)[1].size
        found = {c: [] for c in ("n_a", "n_b", "n_links", "n_shared", "width", "pairs", "times")}
        digests = []
        for lo, hi in batches_of([t or "" for t in texts], BATCH_CHARS):
            x = align_batch(texts[lo:hi], path_a, path_b)
            left, right = x.linked
            document = np.repeat(np.arange(hi - lo), x.n_a)[left]
            codes = size_a * size_b
            unique, times = np.unique(
                document * codes + x.ids_a[left] * size_b + x.ids_b[right], return_counts=True
            )
            found["n_a"].append(x.n_a)
            found["n_b"].append(x.n_b)
            found["n_links"].append(_per_document(x.cut_a.astype(np.int64), x.n_a))
            shared = product_sizes(x.groups_a, x.groups_b.transposed())
            found["n_shared"].append(_per_document(shared, x.n_a))
            found["width"].append(np.bincount(unique // codes, minlength=hi - lo))
            found["pairs"].append(unique % codes)
            found["times"].append(times)
            digests += group_digests(x, size_a, size_b)
        found = {c: np.concatenate(v) for c, v in found.items()}
        pairs, which = np.unique(found["pairs"], return_inverse=True)
        counts = np.bincount(which, found["times"], len(pairs)).astype(np.int64)
        row = found | {"pairs": pairs, "which": which, "counts": counts}
        columns = [pa.array([number], pa.int64())]
        for field in list(arrow)[1:]:
            values = {"keys": keys, "digests": digests}.get(field.name, row.get(field.name))
            flat = values if isinstance(values, pa.Array) else pa.array(values, field.type.value_type)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat).cast(field.type))
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def blocks(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in batches_of([t or "" for t in texts], BLOCK_CHARS):
                if hi > lo:
                    yield block(number, batch.column("key").slice(lo, hi - lo), texts[lo:hi])
                    number += 1

    return docs.mapInArrow(blocks, schema)


REPORT = ("n_a", "n_b", "n_groups", "n_links", "n_shared", "n_best", "count_sum")


def align_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``key``, the ``REPORT`` columns and ``groups_sha256``.

    ``n_best`` counts the links whose pair is linked as often in the corpus as any pair of
    the same id of B, ``count_sum`` adds up the corpus-wide counts of the links' pairs,
    ``n_shared`` is the number of shared-group links.
    """
    path_a, path_b = path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B)
    size_b = piece_side(path_b)[1].size
    key_type = docs.schema[key].dataType
    blocks = store(_blocks(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), path_a, path_b), "aligned")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "p")).select(
        "block", "at", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("count")
    )
    totals = store(pairs.groupBy("pair").agg(F.sum("count").alias("total")), "pairs")
    # At most as many rows as B has ids.
    highest = totals.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("total").alias("most"))
    judged = totals.join(F.broadcast(highest), F.col("pair") % size_b == F.col("b")).select(
        "pair", "total", (F.col("total") == F.col("most")).alias("best")
    )
    back = pairs.select("block", "at", "pair").join(judged, "pair").select(
        F.col("block").alias("of"), "at", "total", "best"
    )

    schema = T.StructType(
        [T.StructField(key, key_type), *[T.StructField(c, T.LongType()) for c in REPORT], T.StructField("groups_sha256", T.StringType())]
    )

    def finish(number, left: pa.Table, right: pa.Table) -> pa.Table:
        at = right.column("at").to_numpy()
        total, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        total[at] = right.column("total").to_numpy()
        best[at] = right.column("best").to_numpy(zero_copy_only=False)
        column = {c: left.column(c).combine_chunks()[0].values for c in left.column_names if c != "block"}
        which, times, width = (column[c].to_numpy() for c in ("which", "times", "width"))
        n_links = column["n_links"]
        out = {
            key: column["keys"], "n_a": column["n_a"], "n_b": column["n_b"], "n_groups": n_links, "n_links": n_links,
            "n_shared": column["n_shared"], "n_best": _per_document(times * best[which], width),
            "count_sum": _per_document(times * total[which], width), "groups_sha256": column["digests"],
        }
        return pa.table(out)

    return blocks.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(finish, schema)


def links(
    docs: DataFrame, kind: str = "overlap", key: str = "doc_id", text: str = "text",
    path_a: str | None = None, path_b: str | None = None,
) -> DataFrame:
    """The links themselves: ``(key, a, b, id_a, id_b, value)``.

    ``a`` and ``b`` number a document's tokens from 0. ``kind="overlap"``: tokens that share
    ``value`` bytes. ``kind="group"``: tokens of one group (``value`` 1), yielded in
    blocks of the product's rows; a group without a cut between has as many links as
    the product of its tokens.
    """
    if kind not in ("overlap", "group"):
        raise ValueError(f"kind must be 'overlap' or 'group', got {kind!r}")
    path_a, path_b = path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B)
    names = [key, "a", "b", "id_a", "id_b", "value"]
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), *[T.StructField(c, T.LongType()) for c in names[1:]]]
    )

    def rows(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in batches_of([t or "" for t in texts], BATCH_CHARS):
                x = align_batch(texts[lo:hi], path_a, path_b)
                document = np.repeat(np.arange(hi - lo), x.n_a)
                first_a, first_b = _starts(x.n_a), _starts(x.n_b)
                pair = (x.bytes_a, x.bytes_b) if kind == "overlap" else (x.groups_a, x.groups_b)
                for first, part in product_blocks(pair[0], pair[1].transposed()):
                    a, b = first + part.row_of_entry(), part.column
                    d = document[a]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("key").take(pa.array(lo + d)),
                            *map(pa.array, (a - first_a[d], b - first_b[d], x.ids_a[a], x.ids_b[b], part.value)),
                        ],
                        names=names,
                    )

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(rows, schema)
