"""plaudit — per-category review scorecards on Spark DataFrames.

One operator (``scorecard``) for three scopes: the whole data set, each
batch, and tumbling or sliding time windows (batch or Structured Streaming).
"""

from plaudit.operators.scorecard import score_summary, scorecard
from plaudit.operators.summarize import summarize

__all__ = ["score_summary", "scorecard", "summarize"]
