"""Plan shapes that matter at scale (pruning, map-side combine, no funnels)."""

from __future__ import annotations

import contextlib
import io

from plaudit.operators import (
    ordinal_rank,
    scorecard,
    sort_order,
    summarize,
    with_day,
    with_scope_totals,
)
from plaudit.sources import brand_summary, load_table, reviews_from_events
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scan_reads_only_used_columns_and_combines_map_side(spark):
    plan = _plan(summarize(reviews_from_events(load_table(spark, SF_SMALL, "events"))))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan
    assert "partial_count(1)" in plan and "partial_sum" in plan


def test_brand_summary_aggregates_before_the_join(spark):
    plan = _plan(brand_summary(load_table(spark, SF_SMALL, "lineitem"), load_table(spark, SF_SMALL, "part")))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_returnflag:string>" in plan
    tree = plan.split("\n\n")[0]
    join_line = next(i for i, line in enumerate(tree.splitlines()) if "Join" in line)
    below = "\n".join(tree.splitlines()[join_line:])
    assert "HashAggregate" in below  # the per-part aggregate sits under the join


def test_totals_use_no_window_and_no_cartesian_product(spark):
    reviews = reviews_from_events(load_table(spark, SF_SMALL, "events"))
    whole = _plan(with_scope_totals(summarize(reviews)))
    assert "Window" not in whole and "CartesianProduct" not in whole
    assert "NestedLoopJoin" not in whole and "Subquery" in whole
    scoped = _plan(with_scope_totals(summarize(with_day(reviews), ["day"]), ["day"]))
    assert "Window" not in scoped and "NestedLoopJoin" not in scoped


def test_rank_windows_only_the_offsets(spark):
    kept = summarize(reviews_from_events(load_table(spark, SF_SMALL, "events")))
    plan = _plan(ordinal_rank(kept.withColumn("avg_points", kept["points"] / kept["reviews"]), sort_order()))
    tree = plan.split("\n\n")[0]
    lines = tree.splitlines()
    window = next(i for i, line in enumerate(lines) if "Window" in line)
    # the window's input is the per-partition counts, an aggregate
    assert any("HashAggregate" in line for line in lines[window:])


def test_scorecard_plan_has_no_python(spark):
    card = scorecard(reviews_from_events(load_table(spark, SF_SMALL, "events")), max_pct_negative=20)
    plan = _plan(card)
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
