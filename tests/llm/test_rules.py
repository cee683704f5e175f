import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from plaudit.llm.rules import BASE, MEASURES, RULES, STOP_WORDS, Rule, judge, rule_report
from tests.conftest import SF_SMALL
from tests.llm.cases import documents, edge_documents, empty_documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, lang):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    forms = {f for w in STOP_WORDS.get(lang, "").split() for f in (w, w.capitalize())}
    m = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_marks": len(re.findall("[!?]{2,}", text)),
        "n_stop": sum(w in forms for w in words),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_bullets": sum(bool(re.match("[ \t]*[-*•‣◦·]", x)) for x in lines),
        "n_ellipses": sum(x.rstrip(" \t\r\x0b\x0c").endswith(("...", "…")) for x in lines),
        "n_repeat_words": len(covered),
    }
    failed = []
    for r in RULES:
        bound = m[r.per] if r.per else 1
        value = m[r.measure] * (100 if r.per else 1)
        outside = (r.low is not None and value < r.low * bound) or (r.high is not None and value > r.high * bound)
        if outside and len(words) >= r.least_words and (not r.langs or lang in r.langs):
            failed.append(r.name)
    return m, failed


def same(rows):
    for r in rows:
        m, failed = brute(r.text, r.lang)
        assert {k: r[k] for k in MEASURES} == m, r.text
        assert r.failed == failed, r.text


def test_measures_equal_plain_python(spark):
    docs = edge_documents(spark)
    rows = judge(docs.withColumn("text_", F.col("text")), keep=("doc_id", "text", "lang")).collect()
    assert len(rows) == docs.count()
    same(rows)


def test_repeated_windows(spark):
    base = prose(4, 300).split()
    texts = [
        "a b c d e a b c d e", "a a a a a a", "a a a a a", "a b c d e x a b c d e", "a b c d e f a b c d e f g",
        "a b c d e\x1cf " * 3, " ".join(base + base[40:47] + base[10:15]), "x " * 30_000, "the end... \nso… \nnot",
        "- a\n* b\n\t• c\nd", "wait!! what?! no! " * 4, "é " * 9 + "漢字", "same\nsame\n same\n\n \nsame",
    ]
    same(judge(documents(spark, texts), keep=("doc_id", "text", "lang")).collect())


def test_table_of_rules_is_data(spark):
    docs = documents(spark, [prose(1, 40), "one two", None])
    rules = (Rule("short", "n_words", low=3), Rule("long", "n_words", high=30))
    assert [r.failed for r in judge(docs, rules).orderBy("doc_id").collect()] == [["long"], ["short"], ["short"]]


def test_verdicts_follow_the_base(spark):
    rows = rule_report(edge_documents(spark)).collect()
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.base_failed == any(b in r.failed_rules.split(",") for b in BASE)
        assert r.kept == (r.failed_rules == "")
    assert rule_report(empty_documents(spark)).count() == 0


def test_one_stage_without_python(spark):
    plan = rule_report(documents(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan


def test_clean_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = rule_report(docs).join(labels, "doc_id").where("quality = 1 and not base_failed")
    assert judged.count() > 100
    assert judged.where("not kept").count() == 0
    junk = rule_report(docs).join(labels, "doc_id").where("quality = 0")
    assert junk.where("kept").count() <= 0.05 * junk.count()


@pytest.mark.parametrize("name", ["op11_threshold_rules"])
def test_oracle(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF_SMALL).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
