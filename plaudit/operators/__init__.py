"""Dataflow operators: aggregate, attach totals, filter, rank, window, score."""

from plaudit.operators.filters import (
    keep_liked,
    keep_popular,
    keep_popular_and_liked,
    liked,
    popular,
)
from plaudit.operators.rank import ordinal_rank
from plaudit.operators.scorecard import score_summary, scorecard, sort_order, with_ratios
from plaudit.operators.summarize import merge_summaries, summarize
from plaudit.operators.totals import scope_totals, with_scope_totals
from plaudit.operators.windows import (
    pane_seconds,
    parse_seconds,
    summarize_windows,
    windows_from_panes,
    with_day,
)

__all__ = [
    "keep_liked",
    "keep_popular",
    "keep_popular_and_liked",
    "liked",
    "merge_summaries",
    "ordinal_rank",
    "pane_seconds",
    "parse_seconds",
    "popular",
    "scope_totals",
    "score_summary",
    "scorecard",
    "sort_order",
    "summarize",
    "summarize_windows",
    "windows_from_panes",
    "with_day",
    "with_ratios",
    "with_scope_totals",
]
