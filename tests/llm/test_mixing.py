import pytest

from plaudit.llm.mixing import mix, mix_report
from tests.llm.cases import documents, edge_documents, empty_documents, prose


def targets_by_hand(sizes, share=1.5, cap=2.0, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        full = [s for s in open_ if left * w[s] / total > cap * sizes[s]]
        if not full:
            return out | {s: left * w[s] / total for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in full)
        open_ -= set(full)
    return out


@pytest.fixture()
def corpus(spark):
    texts = [prose(i, 20 + (i * 37) % 400) for i in range(600)]
    sources = [["b", "a", None, "Z"][min(i % 7, 3)] for i in range(600)]
    return documents(spark, texts, sources), texts, sources


def test_targets_and_taken_words(corpus):
    docs, texts, sources = corpus
    rows = mix_report(docs).collect()
    size = {}
    for t, s in zip(texts, sources, strict=True):
        size[s] = size.get(s, 0) + len(t.split())
    want, taken = targets_by_hand(size), {}
    for r in rows:
        s = sources[r.doc_id]
        assert r.size == len(texts[r.doc_id].split()) and r.source_size == size[s]
        assert r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s in want:
        assert taken[s] <= want[s] + 1e-6 and taken[s] > 0.98 * want[s]


def test_reruns_agree_and_partitions_do_not_matter(corpus):
    docs, _, _ = corpus
    a = {(r.doc_id, r.taken) for r in mix_report(docs).collect()}
    b = {(r.doc_id, r.taken) for r in mix_report(docs.repartition(13)).collect()}
    assert a == b


def test_many_buckets(spark, corpus, monkeypatch):
    monkeypatch.setattr("plaudit.llm.mixing.BUCKET_ROWS", 20)
    docs, _, sources = corpus
    rows = mix_report(docs).collect()
    assert len(rows) == 600
    for s in set(sources):
        own = [r for r in rows if sources[r.doc_id] == s]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, rel=0.03)


def test_inclusion_odds_rise_with_size(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "'a' as source", "if(id % 2 = 0, 1L, 100L) as size")
    rows = mix(df, "size", share=0.5, tilt=1.0).collect()
    long = sum(r.taken_copies for r in rows if r.size == 100) / 2000
    short = sum(r.taken_copies for r in rows if r.size == 1) / 2000
    assert long > short + 0.2


def test_edge_cases(spark):
    docs = edge_documents(spark)
    rows = mix_report(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.taken == 0 for r in rows if r.size == 0)
    assert all(r.taken <= 2 * r.size for r in rows)
    assert mix_report(empty_documents(spark)).count() == 0


def taken_and_left_out(rows):
    """Words missing from the target, and the smallest document that could still be added."""
    taken = sum(r.taken_copies * r.size for r in rows)
    low = min(r.taken_copies for r in rows)
    return rows[0].target - taken, min(r.size for r in rows if r.taken_copies == low and r.size > 0)


@pytest.mark.parametrize(("n", "long", "share"), [(10_000, 2_000_000, 0.3), (20_000, 5_000_000, 0.2)])
def test_document_longer_than_the_want(spark, n, long, share):
    """It is left out, and documents of later buckets fill its place."""
    df = spark.range(n + 1).selectExpr("id as doc_id", "'a' as source", f"if(id = 7, {long}L, 300L) as size")
    missing, least = taken_and_left_out(mix(df, "size", share=share).collect())
    assert 0 <= missing < least


def test_no_document_left_out_would_fit(spark, monkeypatch):
    monkeypatch.setattr("plaudit.llm.mixing.BUCKET_ROWS", 10)
    df = spark.range(3000).selectExpr(
        "id as doc_id", "'a' as source", "cast(1 + pow(1.5, pmod(hash(id), 30)) as long) as size"
    )
    for share in (0.05, 0.5, 1.7):
        missing, least = taken_and_left_out(mix(df, "size", share=share).collect())
        assert 0 <= missing < least


def test_buckets_stay_small(spark, monkeypatch):
    """No rows of a capped source are gathered; small remainders and mixed sizes keep buckets small."""
    from plaudit.llm import mixing

    written, cut = [], mixing.cut
    monkeypatch.setattr(mixing, "cut", lambda df: written.append(cut(df)) or written[-1])
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 100)
    docs = spark.range(40_000).selectExpr(
        "id as doc_id", "if(id < 10000, 'a', 'b') as source", "if(id % 4 = 0, 100000L, 20L + id % 100) as size"
    )
    rows = mix(docs, "size", share=0.9, cap=1.0, weights=(9.0, 1.0)).collect()
    assert {r.taken_copies for r in rows if r.source == "a"} == {1}
    ends = [r for df in written if "__mix_end_source" in df.columns for r in df.collect()]
    assert {r["__mix_end_source"] for r in ends} == {"b"}
    for share in (0.0001, 0.9999):
        written.clear()
        rows = mix(docs, "size", share=share, weights=(1.0, 3.0)).collect()
        for s in "ab":
            missing, least = taken_and_left_out([r for r in rows if r.source == s])
            assert 0 <= missing + 1e-6 and missing < least
        counts = [df.groupBy("__mix_source", "__mix_bucket").count() for df in written if "__mix_bucket" in df.columns]
        assert counts and max(r["count"] for df in counts for r in df.collect()) < 250
