import random
import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from plaudit.llm import packing
from plaudit.llm.packing import ChunkEncoder, best_fit, local_search, pack_documents, pack_lengths, tokenizer_path
from tests.llm.cases import documents, edge_documents, edge_texts, empty_documents, prose


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


ODD = [
    "it's we're 'tis x's' ''s 's 'S don't'll", "a  b   c \n\n d\n e\t\tf \r\n g", "  lead", "trail  ", "\n", " ", "\n\n\n x",
    "12ab34 5,6.7 ½ x²", "naïve café Straße ñandú", "漢字かな交じり 한글 مرحبا", "a b c \x85 d\x1ce", "emoji 🙂🙂 x🙂y",
    "***bold***$$$ %%% ###", "|a|b| c |", "don''t 'll'll", "<|endoftext|>x<|endoftext|>", "ﬁ ǅ Ⅷ ٣", "a 'b' \" 'c", "x́y ​ z",
]


def test_same_ids_as_the_tokenizer(reference):
    texts = ODD + [t or "" for t in edge_texts()]
    rng = random.Random(3)
    alphabet = "ab'sSt 1.2\n\t-é漢  l"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    enc = ChunkEncoder(tokenizer_path())
    for part in (texts, texts[::-1]):
        for text, ids in zip(part, enc.encode(part), strict=True):
            assert ids.tolist() == reference(text), repr(text)
    small = ChunkEncoder(tokenizer_path(), limit=50)  # the store starts anew all the time
    for i in range(0, 60, 7):
        for text, ids in zip(texts[i : i + 7], small.encode(texts[i : i + 7]), strict=True):
            assert ids.tolist() == reference(text)


def test_windows_make_no_difference(reference, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW_CHARS", 20)
    texts = ["", *ODD, "", "a" * 50, *ODD[::-1], "b", ""]
    for text, ids in zip(texts, ChunkEncoder(tokenizer_path()).encode(texts), strict=True):
        assert ids.tolist() == reference(text), repr(text)


MEMORY = """
import random, re
from plaudit.llm.packing import ChunkEncoder, tokenizer_path
peak = lambda: int(re.search(r"VmHWM:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
rng = random.Random(5)
word = lambda: "".join(rng.choices("aeinorst", k=rng.randint(4, 9)))
texts = [" ".join(word() for _ in range(500)) for _ in range(266)]
encode = ChunkEncoder(tokenizer_path())
encode.encode(["a first text"])
before = peak()
assert sum(map(len, encode.encode(texts))) > 200_000
print(peak() - before)
"""


def test_memory_of_a_batch():
    """A million characters, mostly chunks not met before: the arrays of one window and the
    ids, not all encodings at once (some 100 MB)."""
    got = subprocess.run([sys.executable, "-c", MEMORY], capture_output=True, text=True, check=True)
    assert float(got.stdout) < 50


def check(rows, lengths, size=2048):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_pieces_and_sequences(spark, reference):
    texts = [prose(i, 30 + (i * 97) % 900) for i in range(150)] + [prose(900, 5000), None, ""]
    rows = pack_documents(documents(spark, texts).repartition(4)).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    total = 0
    for i, text in enumerate(texts):
        ids, at = np.array([*reference(text), 0], "<u4"), 0
        total += len(ids)
        own = sorted(by_doc[i], key=lambda r: r.piece)
        for n, r in enumerate(own):
            assert (r.piece, r.start) == (n, at)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.length == 2048 or len(own) == 1 or n == 0
            at += r.length
        assert at == len(ids)
        assert len(own) == -(-len(ids) // 2048)
    assert check(rows, None) <= -(-total // 2048) + 1


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 50)
    rows = pack_documents(documents(spark, [prose(i, 200) for i in range(300)])).collect()
    assert len(rows) == 300
    check(rows, None)


def test_local_search_improves_and_keeps_all():
    rng = random.Random(9)
    for size in (20, 100):
        lengths = [rng.randint(1, size) for _ in range(400)]
        # A poor start: each piece where it falls.
        bins, fill = [[]], 0
        for i, n in enumerate(lengths):
            if fill + n > size:
                bins.append([])
                fill = 0
            bins[-1].append(i)
            fill += n
        better = local_search(bins, lengths, size, rounds=10)
        square = lambda bs: sum(sum(lengths[i] for i in b) ** 2 for b in bs)
        assert sorted(i for b in better for i in b) == list(range(400))
        assert all(sum(lengths[i] for i in b) <= size for b in better)
        assert square(better) > square(bins) and len(better) < len(bins)
        assert len(pack_lengths(lengths, size)) <= len(best_fit(lengths, size))


def test_two_for_one_exchange():
    # 6+3 and 5+4+... : giving 6 for 3 and 2 fills the second bin and empties the first.
    lengths = [6, 7, 3, 2]
    got = local_search([[0], [1, 2]], lengths[:3], 13)
    assert [sorted(b) for b in got if sum(lengths[i] for i in b) == 13]


def test_edge_cases(spark):
    docs = edge_documents(spark)
    rows = pack_documents(docs).collect()
    check(rows, None)
    assert sum(r.piece == 0 for r in rows) == docs.count()
    assert [r.length for r in rows if r.doc_id == 0] == [1]
    assert len([r for r in rows if r.doc_id == 5]) == 3
    assert pack_documents(empty_documents(spark)).count() == 0
