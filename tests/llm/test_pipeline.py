import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from plaudit.llm.quality import classify_quality
from plaudit.session import session_conf
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCUMENTS, documents, edge_documents, empty_documents, prose
from tests.llm.test_jaccard import brute
from tests.llm.test_pii import base


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    out.append(docs)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_copies", "personal_data", "mixing", "packing"]
    for df in stages[1:5]:
        assert df.columns == stages[0].columns


def test_quality_stage_keeps_what_scores(spark, stages):
    scored = classify_quality(stages[0], spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    want = {r.doc_id for r in scored.where("score >= 0.3").collect()}
    assert {r.doc_id for r in stages[1].collect()} == want
    assert 0 < len(want) < stages[0].count()


def test_one_of_each_jaccard_class_stays(stages):
    rows = sorted(stages[1].collect(), key=lambda r: r.doc_id)
    _, comp = brute([r.text for r in rows])
    want = {r.doc_id for i, r in enumerate(rows) if comp[i] == i}
    assert {r.doc_id for r in stages[2].collect()} == want


def test_no_personal_data_is_left(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert set(before) == set(after)
    assert any(base(t) for t in before.values())
    for i, r in after.items():
        assert not base(r.text) and r.n_chars == len(r.text)
        if not base(before[i]):
            assert r.text == before[i]


def test_mix_and_packing(stages):
    sizes, taken = {}, {}
    for r in stages[3].collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in stages[4].collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.05)
    assert all(taken[s] <= 2 * sizes[s] for s in taken)
    packed = stages[5].collect()
    assert sum(r.piece == 0 for r in packed) == stages[4].count()
    assert len({r.sequence_id for r in packed}) <= -(-sum(r.length for r in packed) // 2048) + 1


def test_repeated_rows_and_nulls(spark):
    rows = [(1, "a b c d e f g", "en", "x", 13)] * 3 + [(2, None, None, None, None), (None, "q r s t u v", None, None, 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.drop_near_copies(spark, docs, SF_SMALL).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "None"]


def test_unlike_texts_under_one_id_stay(spark):
    a, b, c, d = (prose(i, 40) for i in range(4))
    rows = [(1, a), (7, a), (7, b), (8, c), (8, d), (8, d), (9, ""), (9, ""), (9, None), (None, d), (None, prose(9, 40))]
    docs = spark.createDataFrame([(i, t, "en", "x", None) for i, t in rows], DOCUMENTS)
    kept = [(r.doc_id, r.text) for r in pipeline.drop_near_copies(spark, docs, SF_SMALL).collect()]
    want = [(1, a), (7, b), (8, c), (8, d), (9, ""), (9, None), (None, prose(9, 40))]
    assert sorted(map(repr, kept)) == sorted(map(repr, want))


def test_masking_with_clashing_columns(spark):
    docs = edge_documents(spark)
    masked = pipeline.hide_personal_data(spark, docs, SF_SMALL)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert not any(base(r.text or "") for r in masked.collect())


def test_empty_table(spark):
    docs = empty_documents(spark)
    for _, stage in pipeline.STAGES[1:]:
        assert stage(spark, docs, SF_SMALL).count() == 0
    assert pipeline.keep_quality(spark, docs, SF_SMALL).count() == 0


def test_run(spark):
    assert pipeline.run(spark, SF_SMALL).where(F.col("length") > 2048).count() == 0
    assert re.match("[a-z_]+$", pipeline.STAGES[0][0])


def test_stages_hand_few_texts_to_a_worker_at_once(spark):
    """What a stage returns is written later, by whoever called it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = documents(spark, [prose(i, 30) for i in range(20)])
    with session_conf(spark, {key: "10000"}):
        pipeline.keep_quality(spark, docs, SF_SMALL)
        assert spark.conf.get(key) == "1000"
    with session_conf(spark, {key: "7"}):
        pipeline.pack_sequences(spark, docs, SF_SMALL)
        assert spark.conf.get(key) == "7"
