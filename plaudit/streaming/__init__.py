"""Structured Streaming: stage-1 windowed summaries, stage-2 scoring."""

from plaudit.streaming.clock import IDLE_CONF, ArrivalClock
from plaudit.streaming.history import History
from plaudit.streaming.ledger import Account, BatchLedger
from plaudit.streaming.maintained import maintained_scorecard, read_maintained, update_summary
from plaudit.streaming.recover import ManifestMismatch, check_manifest, manifest_of, start_or_recover
from plaudit.streaming.reports import ReportLog
from plaudit.streaming.totals import scored_stream, stream_with_totals
from plaudit.streaming.windowed import (
    late_rows,
    open_summary,
    read_summary,
    run_for,
    score_closed_windows,
    start_summary_stream,
    stream_reviews,
    summarize_stream,
    windowed_scorecard,
)

__all__ = [
    "IDLE_CONF",
    "Account",
    "ArrivalClock",
    "BatchLedger",
    "History",
    "ManifestMismatch",
    "ReportLog",
    "check_manifest",
    "late_rows",
    "maintained_scorecard",
    "manifest_of",
    "open_summary",
    "read_maintained",
    "read_summary",
    "run_for",
    "score_closed_windows",
    "scored_stream",
    "start_or_recover",
    "start_summary_stream",
    "stream_reviews",
    "stream_with_totals",
    "summarize_stream",
    "update_summary",
    "windowed_scorecard",
]
