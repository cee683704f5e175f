"""Sources: driver tables, review adapters, JSON-lines reviews."""

from plaudit.sources.adapters import brand_summary, reviews_from_events, reviews_from_lineitem
from plaudit.sources.json_reviews import parse_json_column, read_reviews, split_lenient
from plaudit.sources.tables import load_table, stream_table

__all__ = [
    "brand_summary",
    "load_table",
    "parse_json_column",
    "read_reviews",
    "reviews_from_events",
    "reviews_from_lineitem",
    "split_lenient",
    "stream_table",
]
