"""Contracts of the registered queries on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

COLUMNS = {
    1: "doc_id size text_crc32 law shard slot grown_shard",
    2: "vec_id n_links component_id kept",
    3: "doc_id size source_size target taken",
    4: "doc_id n_bytes n_removed n_spans kept_sha256",
    5: "doc_id held_out score predicted",
    6: "doc_id piece start length ids_crc32 sequence_id offset",
    7: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    8: "doc_id n_shingles component_id",
    9: "doc_id held_out score predicted",
    10: "query_id rank vec_id score",
    11: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    12: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    13: "lang source part item value rank",
}


@pytest.mark.parametrize("n", COLUMNS)
def test_columns(spark, n):
    (name,) = [q for q in entry.queries() if q.startswith(f"op{n}_")]
    df = entry.queries()[name](spark, SF_SMALL)
    assert set(COLUMNS[n].split()) <= set(df.columns)
    rows = {13: None, 2: "embeddings", 10: None, 6: None}.get(n, "documents")
    if rows:
        assert df.count() == spark.read.parquet(f"{SF_SMALL}/{rows}.parquet").count()


@pytest.mark.parametrize(
    "name", ["op2_e8_near_vectors", "op4_suffix_grouping_dedup", "op8_jaccard_metric_join", "op10_mtree_topk"]
)
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    found = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF_SMALL)
    assert sorted(map(tuple, got.select(found.columns).collect())) == sorted(found.fetchall())


def test_pipeline_is_registered():
    assert "pipeline" in entry.queries()
