"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

#: results depend on it: month, quarter and year differences read the session zone
FIXED_CONF = {"spark.sql.session.timeZone": "UTC"}

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: defaults; whatever is set on the cluster or the command line stays
DEFAULT_CONF = {
    # runtime re-planning: coalesce small shuffle partitions, split skewed join
    # partitions, switch a join to broadcast only when the measured side is small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # streaming state (dedup / aggregation keys) lives off-heap and spills to disk
    STATE_STORE: ROCKSDB,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app_name: str = "shopflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the shopflow defaults.

    ``shuffle_partitions`` should be sized so one partition fits an executor
    core's memory at the target scale (e.g. input bytes / 128 MB); AQE then
    coalesces the partitions that turn out small.
    """
    SparkContext._ensure_initialized()  # so that SparkConf shows what was given outside
    given = SparkConf()
    settings = {k: v for k, v in DEFAULT_CONF.items() if not given.contains(k)} | FIXED_CONF
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def import_in_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed (local runs)."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, ROOT]))


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside hold their state in RocksDB, also in a session that was built with another
    store: a stream keeps the settings of its start, the session gets its own back."""
    given = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, given)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  Only when it is
    unset, ``fallback`` is installed and returned; without one, a session in
    one JVM (``local[n]``) gets a scratch folder and any other is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if fallback is None:
        if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is None:
            raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder as fallback")
        fallback = tempfile.mkdtemp(prefix="shopflow-checkpoints-")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one for tables that only this run reads.

    All of a run's such folders lie in one, which is removed when the driver's JVM ends.
    """
    run = f"{checkpoint_dir(spark).rstrip('/')}/runs/{spark.sparkContext.applicationId}"
    at = spark._jvm.org.apache.hadoop.fs.Path(run)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(at)
    store.deleteOnExit(at)
    return f"{run}/{name}-{uuid.uuid4().hex}"


def stream_checkpoint(spark: SparkSession, name: str, base: str | None = None) -> str:
    """Per-query streaming checkpoint location below the shared folder."""
    root = base or checkpoint_dir(spark)
    return os.path.join(root, "streams", name)
