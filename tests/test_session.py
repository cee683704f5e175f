"""The shared folder: taken from the cluster, refused where it is missing, cleared."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile
from pathlib import Path

import pytest

from plaudit.session import ensure_checkpoint_dir, scratch_path, session_conf


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}


class _Session:
    sparkContext = _Context()


def test_no_scratch_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session())


def test_written_tables_share_one_folder(spark):
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    assert os.path.dirname(a) == os.path.dirname(b) and a != b


def test_written_tables_go_when_the_application_ends():
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    code = f"""
from plaudit.session import build_session, scratch_path
spark = build_session("local[1]", 1, extra_conf={{"spark.checkpoint.dir": "file://{folder}"}})
path = scratch_path(spark, "table")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
"""
    root = str(Path(__file__).resolve().parents[1])
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, capture_output=True, timeout=180)
    left = [p for p in Path(folder).rglob("*") if "plaudit-" in str(p)]
    assert left == []


def test_session_conf_comes_back(spark):
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    with session_conf(spark, {key: "3"}):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == old
