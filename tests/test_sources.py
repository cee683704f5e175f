"""Measures, casts and the JSON-lines reader (T1, T2, T6, F7)."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from plaudit.functions import lenient_points, negative_flag, signed_points, strict_points
from plaudit.operators import scorecard
from plaudit.sinks import write_scorecard
from plaudit.sources import read_reviews


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_label_tests_are_case_insensitive_without_trim(spark):
    df = spark.createDataFrame(
        [("NEGATIVE", 3), ("Positive", 4), (" negative", 5), (None, 6), ("neutral", 7)],
        "evaluation STRING, points BIGINT",
    )
    got = df.select(negative_flag().alias("n"), signed_points().alias("s")).collect()
    assert [(r.n, r.s) for r in got] == [(1, -3), (0, 4), (0, 0), (0, 0), (0, 0)]


def test_point_casts(spark):
    df = spark.createDataFrame([("7",), (" 7 ",), ("3.7",), ("-3.7",), ("x",), (None,)], "p STRING")
    got = [r.v for r in df.select(lenient_points("p").alias("v")).collect()]
    assert got == [7, 7, 3, -3, None, None]
    odd = ["9007199254740993", "-9223372036854775808", "7d", "7f", "0x7", "1e2", ".5", "5.", "+3", "NaN", "Infinity", "", "--1"]
    df = spark.createDataFrame([(p,) for p in odd], "p STRING")
    got = [r.v for r in df.select(lenient_points("p").alias("v")).collect()]
    assert got == [9007199254740993, -9223372036854775808, None, None, None, 100, 0, 5, 3, None, None, None, None]
    clean = spark.createDataFrame([("7",), (" 7 ",), ("-2",)], "p STRING")
    assert [r.v for r in clean.select(strict_points("p").alias("v")).collect()] == [7, 7, -2]
    with pytest.raises(Exception):
        spark.createDataFrame([("3.5",)], "p STRING").select(strict_points("p")).collect()


GOOD = """{"cuisine": "Donuts", "evaluation": "Positive", "points": 9}
{"cuisine": "Donuts", "evaluation": "negative", "points": "2"}

{"evaluation": "positive", "points": 1}
{"cuisine": "Thai", "evaluation": "neutral", "points": " 4 "}
"""


def test_strict_reader_skips_blank_lines_and_keeps_null_group(spark, scratch):
    _write(scratch, "a.json", GOOD)
    rows = read_reviews(spark, scratch, "strict").collect()
    assert sorted((r.category or "", r.evaluation, r.points) for r in rows) == [
        ("", "positive", 1),
        ("Donuts", "Positive", 9),
        ("Donuts", "negative", 2),
        ("Thai", "neutral", 4),
    ]


@pytest.mark.parametrize(
    "line",
    [
        "{not json",
        '{"cuisine": "x", "evaluation": null, "points": 1}',
        '{"cuisine": "x", "evaluation": "positive", "points": "3.5"}',
        '{"cuisine": "x", "evaluation": "positive"}',
    ],
)
def test_strict_reader_fails_on_bad_rows(spark, scratch, line):
    _write(scratch, "a.json", GOOD + line + "\n")
    with pytest.raises(Exception):
        read_reviews(spark, scratch, "strict").collect()


def test_lenient_reader_routes_bad_rows_to_rejects(spark, scratch):
    bad = (
        "{not json\n"
        '{"cuisine": "x", "evaluation": null, "points": 1}\n'
        '{"cuisine": "x", "evaluation": "positive", "points": "3.5"}\n'
        '{"cuisine": "x", "evaluation": "positive", "points": "abc"}\n'
    )
    _write(scratch, "a.json", GOOD + bad)
    good, rejects = read_reviews(spark, scratch, "lenient")
    assert sorted(r.reason for r in rejects.collect()) == ["bad points", "malformed", "no evaluation"]
    got = sorted((r.category or "", r.points) for r in good.collect())
    assert got == [("", 1), ("Donuts", 2), ("Donuts", 9), ("Thai", 4), ("x", 3)]


def test_write_scorecard_round_trip(spark, scratch):
    _write(scratch, "a.json", GOOD)
    card = scorecard(read_reviews(spark, scratch, "strict"), max_pct_negative=60)
    out = os.path.join(scratch, "out")
    write_scorecard(card, out, fmt="json")
    back = spark.read.json(out)
    assert {r.category for r in back.collect()} == {r.category for r in card.collect()}
    write_scorecard(card, out, fmt="json")  # overwrite
    assert spark.read.json(out).count() == card.count()


def test_json_column_parse(spark):
    df = spark.createDataFrame([('{"k": 69}',), ('{"k": "7.9"}',), ("{bad",)], "props STRING")
    from plaudit.sources import parse_json_column

    got = parse_json_column(df, "props", "k STRING").select(lenient_points(F.col("parsed.k")).alias("p"))
    assert [r.p for r in got.collect()] == [69, 7, None]


def test_key_match_is_case_sensitive(spark, scratch):
    _write(scratch, "a.json", '{"Cuisine": "x", "evaluation": "positive", "points": 1}\n')
    assert [r.category for r in read_reviews(spark, scratch, "strict").collect()] == [None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_points_fail_without_ansi_too(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        ok = spark.createDataFrame([(" 7 ",), (None,)], "p STRING").select(strict_points("p").alias("v"))
        assert [r.v for r in ok.collect()] == [7, None]
        with pytest.raises(Exception, match="not an integer"):
            spark.createDataFrame([("3.5",)], "p STRING").select(strict_points("p")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


TIMED = [
    {"cuisine": "a", "evaluation": "positive", "points": 1, "ts": "2024-01-01T00:00:00Z"},
    {"cuisine": "b", "evaluation": "positive", "points": 1, "ts": "yesterday"},
    {"cuisine": "c", "evaluation": "positive", "points": 1},
]


@pytest.mark.parametrize("needs_time", [False, True])
def test_bad_times_do_not_depend_on_the_columns_read(spark, scratch, needs_time):
    _write(scratch, "a.json", "\n".join(json.dumps(r) for r in TIMED) + "\n")
    good, rejects = read_reviews(spark, scratch, "lenient", needs_time=needs_time)
    want = {"a"} if needs_time else {"a", "c"}
    for columns in (["category"], ["category", "ts"], ["category", "points", "evaluation", "ts"]):
        assert {r.category for r in good.select(*columns).collect()} == want
    assert good.count() == len(want)
    for columns in (["cuisine"], ["cuisine", "ts", "reason"]):
        assert {r.cuisine for r in rejects.select(*columns).collect()} == {"a", "b", "c"} - want
    strict = read_reviews(spark, scratch, "strict", needs_time=needs_time)
    for columns in (["category"], ["ts"]):
        with pytest.raises(Exception, match="readable time"):
            strict.select(*columns).collect()


def test_windows_fail_on_a_missing_time_or_drop_it_when_told(spark):
    from plaudit.operators import summarize_windows

    df = spark.createDataFrame(
        [("a", "positive", 1, "2024-01-01 00:00:00"), ("a", "positive", 1, None)],
        "category STRING, evaluation STRING, points BIGINT, t STRING",
    ).withColumn("ts", F.to_timestamp("t"))
    with pytest.raises(Exception, match="without a time"):
        summarize_windows(df, "ts", "1 day").collect()
    assert [r.reviews for r in summarize_windows(df, "ts", "1 day", missing_time="drop").collect()] == [1]


def test_stream_table_reads_a_file_or_a_folder(spark, scratch):
    from plaudit.sources import load_table, stream_table

    load_table(spark, "/root/testdata/sf0.001", "nation").repartition(3).write.parquet(f"{scratch}/nation.parquet")
    for i, folder in enumerate(["/root/testdata/sf0.001", scratch]):
        q = stream_table(spark, folder, "nation").writeStream.format("parquet").option(
            "checkpointLocation", f"{scratch}/c{i}").option("path", f"{scratch}/o{i}").trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.read.parquet(f"{scratch}/o{i}").count() == 25
