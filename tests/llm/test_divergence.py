import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from plaudit.llm import divergence
from plaudit.llm.divergence import UNIT, audit, terms_of
from plaudit.llm.transducer import Transducer
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCUMENTS, edge_documents, empty_documents, prose

PATTERN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=3, top=200):
    docs = [(lang or "", source or "", PATTERN.findall(lowered(text or ""))) for text, lang, source in rows]
    df, count, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, _, terms in docs:
        df[lang].update(set(terms))
    kept = {lang: {t for t, n in c.items() if n >= least} for lang, c in df.items()}
    for lang, source, terms in docs:
        known = [t for t in terms if t in kept[lang]]
        count[lang, source].update(known)
        total[lang].update(known)

    def shares(counter, lang):
        whole = sum(counter.values()) + len(kept[lang])
        return {t: 1 + UNIT * (counter[t] + 1) // whole for t in kept[lang]}

    p = {g: shares(count[g], g[0]) for g in {(lang, s) for lang, s, _ in docs}}
    q = {lang: shares(total[lang], lang) for lang in kept}
    out = []
    for lang, source in p:
        mine = p[lang, source]
        found = {"pair": [], "term": []}
        for other_lang, other in p:
            if other_lang == lang and other != source:
                theirs = p[lang, other]
                found["pair"].append((other, sum((mine[t] - theirs[t]) ** 2 // theirs[t] for t in mine)))
        for t, x in mine.items():
            if count[lang, source][t] and x > q[lang][t]:
                found["term"].append((t, (x - q[lang][t]) ** 2 // q[lang][t]))
        for part, items in found.items():
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            limit = len(items) if part == "pair" else top
            out += [(lang, source, part, item, v, r + 1) for r, (item, v) in enumerate(items[:limit])]
    return sorted(out)


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def corpus(spark, n=60):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        text = prose(i % 7, 60, 80) + rng.choice([" Été ÉTÉ", " ĀĀ x\x7fy", " 漢字 漢字x", " A_b-C", ""]) + rng.choice([" 🙂z", " �", ""])
        rows.append((i, text, rng.choice(["en", "en", "de", None, "xx" if i < 2 else "en"]), rng.choice(["a", "b", "é", "", None]), 1))
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.mark.parametrize("shard_terms,salt,tile,cells", [(50_000, 100_000, 64, 1 << 20), (7, 9, 2, 64)])
def test_equals_plain_counting(spark, monkeypatch, shard_terms, salt, tile, cells):
    monkeypatch.setattr(divergence, "SALT_DOCUMENTS", salt)
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "CELLS", cells)
    docs = corpus(spark).repartition(5)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    want = brute(rows, top=15)
    assert got(audit(docs, top=15, shard_terms=shard_terms)) == want
    assert {"pair", "term"} == {w[2] for w in want} and any(w[0] == "" for w in want)


def test_odd_rows(spark):
    docs = edge_documents(spark)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert got(audit(docs)) == brute(rows)
    assert got(audit(empty_documents(spark))) == []


def test_no_kept_terms(spark):
    docs = spark.createDataFrame([(1, "x", "en", "a", 1), (2, "y", "en", "b", 1)], DOCUMENTS)
    assert got(audit(docs)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_large_counts_stay_exact(spark):
    rows = [(30_000_000_000, 70_000_000_001), (0, 3), (9_999_999_999_999, 10_000_000_000_000)]
    df = spark.createDataFrame(rows, "n long, total long")
    found = df.select("n", "total", divergence.share(df["n"], df["total"]).alias("p")).collect()
    assert all(r.p == 1 + UNIT * (r.n + 1) // r.total for r in found)


@settings(max_examples=80, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).filter(lambda b: b"\n" not in b), max_size=60), st.lists(st.binary(max_size=5), max_size=20))
def test_transducer(terms, others):
    ordered = sorted(terms)
    t = Transducer.build(ordered)
    assert [t.ordinal(x) for x in ordered] == list(range(len(ordered))) and t.size == len(ordered)
    assert all(t.ordinal(x) == -1 for x in others if x not in terms) and list(t.terms()) == ordered
    back = Transducer.load(**t.dump())
    assert back.size == t.size and list(back.terms()) == ordered and [back.ordinal(x) for x in ordered] == list(range(len(ordered)))
    # Minimal: as many states as there are distinct sets of endings.
    endings = {frozenset(x[len(p):] for x in terms if x.startswith(p)) for x in terms for p in (x[:i] for i in range(len(x) + 1))}
    assert len(t.steps) == max(1, len(endings))


def test_transducer_recounts_runs_and_wants_order():
    t = Transducer.build([b"ab", b"abc", b"b"])
    assert t.recount(b"abc\nb\nzz\nabc", np.array([2, 5, 9, 1])).tolist() == [0, 3, 5]
    for wrong in ([b"b", b"a"], [b"a", b"a"]):
        with pytest.raises(ValueError):
            Transducer.build(wrong)


@settings(max_examples=100, deadline=None)
@given(st.text())
def test_terms(text):
    assert [t.decode() for t in terms_of(text)] == PATTERN.findall(lowered(text))


def test_oracle(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.sql(entry.oracle_sql()["op13_transducer_divergence"]).fetchall()
    assert got(entry.queries()["op13_transducer_divergence"](spark, SF_SMALL)) == sorted(want)
