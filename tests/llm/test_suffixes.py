import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from plaudit.llm import suffixes
from plaudit.llm.gsaca import suffix_arrays
from plaudit.llm.suffixes import LENGTH, anchors, remove_repeats
from tests.llm.cases import documents, edge_documents, empty_documents, prose


def test_suffix_arrays_same_as_sorting():
    rng = random.Random(1)
    strings = [[rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 50))] + [0] for _ in range(300)]
    strings += [[1] * 60 + [0], [2, 1] * 25 + [0], [1, 2] * 25 + [0], [3, 2, 1] * 9 + [0], [1, 1, 2] * 12 + [0], [0]]
    got = suffix_arrays(np.array([x for s in strings for x in s], np.int32), np.array([len(s) for s in strings]))
    at = 0
    for s in strings:
        assert (got[at : at + len(s)] - at).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        at += len(s)
    assert len(suffix_arrays(np.zeros(0, np.int32), np.zeros(0, np.int64))) == 0


def test_every_window_holds_an_anchor_at_a_fixed_place():
    a, b = prose(1, 80).encode(), prose(2, 80).encode()
    shared = prose(3, 30).encode()
    texts = [a + shared + b, b + b"--" + shared + a, b"ab" * 100, b"short"]
    text, at, h = anchors(texts)
    for t, raw in enumerate(texts):
        have = set(at[text == t].tolist())
        for s in range(len(raw) - LENGTH + 1):
            assert any(s <= p <= s + LENGTH - suffixes.GRAM for p in have)
    inside = [
        {(p - raw.index(shared), x) for i, p, x in zip(text, at, h, strict=True) if i == t
         and raw.index(shared) + 30 < p < raw.index(shared) + len(shared) - 60}
        for t, raw in enumerate(texts[:2])
    ]
    assert inside[0] == inside[1] and inside[0]


def brute(texts, n=LENGTH):
    raws, first, out = [(t or "").encode() for t in texts], {}, []
    for d, r in enumerate(raws):
        for i in range(len(r) - n + 1):
            first.setdefault(r[i : i + n], d)
    for d, r in enumerate(raws):
        gone = [False] * len(r)
        for i in range(len(r) - n + 1):
            if first[r[i : i + n]] < d:
                gone[i : i + n] = [True] * n
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng, out = random.Random(8), []
    passages = [prose(100 + i, 12) for i in range(4)] + ["é" * 40, "ab" * 60, "z" * 49, "y" * 50]
    for i in range(70):
        parts = [prose(i, rng.randint(1, 25))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 5)
            parts += [p[cut : len(p) - rng.randint(0, 5)], prose(1000 + rng.randint(0, 500), rng.randint(0, 8))]
        out.append(" ".join(parts))
    for i in range(20):
        w = out[i].split()
        w[rng.randrange(len(w))] = "edit"
        out.append(" ".join(w))
    return out + [out[3], out[3], None, "", out[0][:50], out[0][:49], out[5][10:]]


@pytest.mark.parametrize(("hot", "contexts"), [(4096, 12), (4096, 2), (3, 12), (1, 12)])
def test_same_as_brute_force(spark, monkeypatch, hot, contexts):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "STRING_CONTEXTS", contexts)
    monkeypatch.setattr(suffixes, "TASK_CONTEXTS", 300)
    texts = corpus()
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(documents(spark, texts).repartition(5)).collect()}
    want = brute(texts)
    assert sum(w[1] for w in want) > 3000
    assert [got[i] for i in range(len(texts))] == want


def test_edge_cases(spark):
    docs = edge_documents(spark)
    rows = remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: r for r in rows}
    empty = hashlib.sha256(b"").hexdigest()
    assert (got[0].n_bytes, got[0].n_removed, got[0].kept_sha256) == (0, 0, empty)
    assert got[5].n_removed == 0 and got[None].n_removed == 0
    assert got[6].n_removed == got[6].n_bytes and got[6].n_spans == 1 and got[6].kept_sha256 == empty
    assert 0 < got[7].n_removed < got[7].n_bytes
    assert got[10].n_removed == got[11].n_removed == 0  # repeats within one document stay
    assert remove_repeats(empty_documents(spark)).count() == 0


def test_memory_of_a_batch(monkeypatch):
    monkeypatch.setattr(suffixes, "_grams", suffixes.Grams())
    texts = [prose(i, 400, 4_000) for i in range(900)]
    assert sum(map(len, texts)) > 2_000_000
    every = type("Every", (), {"has": lambda self, bits: np.ones(len(bits), bool)})()
    batch = pd.DataFrame({"bit": np.zeros(len(texts), np.int64), "text": texts})
    tracemalloc.start()
    found = list(suffixes._count_anchors(every)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 1 and len(found[0]) > 10_000
    assert peak < 80_000_000


def test_contexts_are_the_same_when_few_are_remembered(spark, monkeypatch):
    texts = corpus()
    docs = documents(spark, texts).coalesce(1)
    monkeypatch.setattr(suffixes, "SEEN_CONTEXTS", 0)
    rows = {r.doc_id: tuple(r)[1:] for r in remove_repeats(docs).collect()}
    assert [rows[i] for i in range(len(texts))] == brute(texts)
