"""Sinks: batch scorecards to files or the console; streams write in ``streaming``."""

from plaudit.sinks.writers import show_scorecard, write_scorecard

__all__ = ["show_scorecard", "write_scorecard"]
