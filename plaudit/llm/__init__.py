"""Operators for preparing training corpora (sharding, dedup, mixing, ...).

Nothing else in the package imports this subpackage; ``queries.py`` holds the
queries that ``__spark_entry__`` registers when the subpackage is present.
"""
