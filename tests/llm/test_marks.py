import numpy as np
from pyspark.sql import functions as F

from plaudit.llm.common import components, held_out, uniform
from plaudit.llm.marks import Marks


def test_marks_miss_no_member_and_pass_few_others(spark):
    members = spark.range(0, 5000, 5).withColumnRenamed("id", "x")
    marks = Marks(members, F.xxhash64("x"), 1000)
    rows = spark.range(5000).select("id", marks.bit(F.xxhash64("id")).alias("bit")).toPandas()
    has = marks.has(rows["bit"].to_numpy(np.int64))
    inside = rows["id"].to_numpy() % 5 == 0
    assert has[inside].all() and has[~inside].mean() < 0.05


def test_marks_of_nothing(spark):
    marks = Marks(spark.range(0).withColumnRenamed("id", "x"), F.xxhash64("x"), 0)
    assert not marks.has(np.arange(100)).any()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(spark, df).collect()}
    assert all(got[i] == 100 for i in range(100, 161))
    assert all(got[i] == 500 for i in range(500, 560))
    assert got[8] == got[9] == 8 and 7 not in got
    assert components(spark, df.limit(0)).count() == 0


def test_held_out_is_the_contract_fold(spark):
    import zlib

    rows = spark.range(300).select("id", held_out(F.col("id")).alias("h"), uniform(F.col("id")).alias("u")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) and 0 < r.u < 1 for r in rows)
    assert abs(sum(r.u for r in rows) / 300 - 0.5) < 0.06
