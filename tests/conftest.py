from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plaudit.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", shuffle_partitions=8)
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never cleared; /tmp is scratch space)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def reviews_df(spark, rows, with_ts=False):
    """Literal review rows ``(category, evaluation, points[, ts])``."""
    schema = "category STRING, evaluation STRING, points BIGINT"
    if with_ts:
        schema += ", ts TIMESTAMP"
    return spark.createDataFrame(rows, schema)
