import zlib
from collections import Counter, defaultdict

from plaudit.llm.sharding import Leaf, build_tree, descend, grow, reweigh, shard_documents
from tests.llm.cases import edge_documents, empty_documents


def test_contract_columns_slots_and_growth(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('é', cast(id % 7 as int)) as text")
    rows = shard_documents(docs, build_tree(24)).collect()
    assert len(rows) == 3000
    slots = defaultdict(list)
    for r in rows:
        text = "é" * (r.doc_id % 7)
        assert r.size == len(text.encode()) + 8 and r.text_crc32 == zlib.crc32(text.encode()) and r.law == "key"
        assert r.grown_shard == r.shard or r.grown_shard == 24
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r.grown_shard == 24 for r in rows)
    assert 60 < moved < 200  # a 25th of the rows


def test_slots_do_not_depend_on_parts(spark):
    from plaudit.llm.sharding import number_slots

    df = spark.range(1000).selectExpr("id as doc_id", "cast(id % 2 as int) as shard")
    rows = number_slots(df, "shard", ["doc_id"], 1000, part_rows=90).collect()
    for s in (0, 1):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(500))


def test_weights_and_confined_movement(spark):
    tree = build_tree(24)
    heavier = reweigh(tree, 3, 2.0)
    keys = spark.range(40_000).withColumnRenamed("id", "k")
    both = descend(descend(keys, "k", tree, "a"), "k", heavier, "b").collect()
    place = {x.shard: x for x in tree}
    for r in both:
        if r.a != r.b:
            was, now = place[r.a], place[r.b]
            # Only into the changed region; within it only into the changed
            # rack; within that only onto the changed shard.
            assert now.region == 0
            if was.region == 0:
                assert now.rack == 0
                if was.rack == 0:
                    assert now.shard == 3
    share = Counter(r.b for r in both)
    assert abs(share[3] / 40_000 - 2 / 25) < 0.01
    assert abs(share[20] / 40_000 - 1 / 25) < 0.01


def test_growth_by_a_region_takes_rows_only_into_itself(spark):
    tree = [Leaf(0, 0, 0, 2.0), Leaf(0, 0, 1, 1.0), Leaf(1, 1, 2, 3.0)]
    more = grow(tree, 1.5)
    rows = descend(descend(spark.range(5000), "id", tree, "a"), "id", more, "b").collect()
    assert {r.b for r in rows if r.a != r.b} == {3}


def test_edge_cases(spark):
    rows = shard_documents(edge_documents(spark), build_tree(24)).collect()
    assert len(rows) == edge_documents(spark).count()
    assert all(r.shard is not None and r.slot is not None for r in rows)
    assert {r.size for r in rows if r.doc_id == 0} == {8}
    same = [r for r in rows if r.doc_id == 5]
    assert len({r.shard for r in same}) == 1 and len({r.slot for r in same}) == 3
    assert shard_documents(empty_documents(spark), build_tree(24)).count() == 0
