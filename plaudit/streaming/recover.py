"""STR7: start a stream, or recover the one a work folder belongs to.

A checkpoint holds the state of one query, but not what the query was: Spark resumes it under
any plan whose state looks alike, so another window length or start would add
new windows to old ones without a word. :func:`start_or_recover` keeps a *manifest* beside the
checkpoint and refuses to resume under another one, naming what differs; a query of the
same name that is still running in this session is given back instead of started twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from plaudit.streaming.ledger import read_or_empty

SCHEMA = "manifest STRING"
# May change between runs: rows already dropped stay so, the state is the same.
FREE = ("horizon",)


class ManifestMismatch(ValueError):
    """The work folder belongs to a stream of other parameters."""


def manifest_of(stream: DataFrame, **parameters) -> dict[str, str]:
    """What makes a stream's state: its parameters and the schema it writes."""
    fields = {k: str(v) for k, v in parameters.items()}
    return fields | {"schema": stream.schema.simpleString()}


def read_manifest(spark: SparkSession, path: str) -> dict[str, str] | None:
    rows = read_or_empty(spark, path, SCHEMA).limit(1).collect()
    return json.loads(rows[0]["manifest"]) if rows else None


def check_manifest(spark: SparkSession, path: str, manifest: Mapping[str, str]) -> None:
    """Write the manifest of a new work folder; raise if an existing one differs."""
    known = read_manifest(spark, path)
    if known is None:
        row = [(json.dumps(dict(manifest), sort_keys=True),)]
        spark.createDataFrame(row, SCHEMA).coalesce(1).write.mode("append").json(path)
        return
    names = [n for n in sorted({*known, *manifest}) if n not in FREE]
    apart = [f"{n}: {known.get(n)!r} there, {manifest.get(n)!r} now" for n in names if known.get(n) != manifest.get(n)]
    if apart:
        raise ManifestMismatch(f"{path} belongs to another stream ({'; '.join(apart)}); use a new work folder")


def start_or_recover(
    spark: SparkSession,
    name: str,
    manifest_path: str,
    manifest: Mapping[str, str],
    start: Callable[[str], StreamingQuery],
) -> StreamingQuery:
    """The running query ``name``, or ``start(name)`` on its checkpoint."""
    check_manifest(spark, manifest_path, manifest)
    for query in spark.streams.active:
        if query.name == name:
            return query
    return start(name)
