"""Session helpers: a configured SparkSession and the shared checkpoint folder.

Everything that cuts lineage (``DataFrame.checkpoint``) or writes an
intermediate table goes below the folder the cluster names in
``spark.checkpoint.dir``. The library never invents one on a cluster;
only :func:`ensure_checkpoint_dir` (used by tests, the bench and the local
driver entry) sets a scratch folder, only when none is configured and only
where the master is local. Written tables live in one folder per application
below it, which goes when the application ends.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Session settings the library relies on. AQE is what turns a small
# scope-totals join into a broadcast at runtime (a checked size with a
# sort-merge fallback) and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once the DataFrames that use them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


# Stage-1 streaming state kept in RocksDB (off-heap, spills to local disk,
# changelog checkpoints to the checkpoint folder): for many (window, category)
# keys. Slower than the default provider for small state.
LARGE_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "plaudit",
    extra_conf: dict[str, str] | None = None,
    large_state: bool = False,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators expect.

    ``master`` and ``shuffle_partitions`` are left to ``spark-submit`` / the
    cluster unless given (tests and the bench pass ``local[N]`` and N); AQE
    coalesces small shuffle partitions and splits skewed ones either way.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if large_state:
        conf.update(LARGE_STATE_CONF)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Run-time settings for a block; what was set before comes back after it."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session; error if none is set."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the server owns the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
        raise RuntimeError("no checkpoint folder: set spark.checkpoint.dir") from None
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "no checkpoint folder: set spark.checkpoint.dir to a shared folder "
        "(or call plaudit.session.ensure_checkpoint_dir in local runs)"
    )


def ensure_checkpoint_dir(spark: SparkSession, parent: str = "/tmp") -> str:
    """Use the configured checkpoint folder; set a scratch one only if unset.

    For tests and single-machine runs. A scratch folder is local to a machine,
    so on any other master than ``local`` a missing setting is an error.
    """
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir=parent))
        return spark.sparkContext.getCheckpointDir()


_roots: dict[tuple[str, str], str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for a written table.

    All of an application's are below one folder, which the file system client
    deletes when the driver's JVM ends.
    """
    base = checkpoint_dir(spark).rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's folder, cleared there
        return f"{base}/plaudit-{name}-{uuid.uuid4().hex}"
    key = (sc.applicationId, base)
    if key not in _roots:
        root = f"{base}/plaudit-{uuid.uuid4().hex}"
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _roots[key] = root
    return f"{_roots[key]}/{name}-{uuid.uuid4().hex}"
