"""Session defaults and the shared folder used by jobs that write and read back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Stream state off the Java heap, locally as on a cluster.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "haulmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; shuffle width is left to AQE on a cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a temporary folder; on a cluster a
    missing setting is an error, because executors do not share local disks.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    return _local_root()


@lru_cache(maxsize=1)
def _local_root() -> str:
    """Scratch space of a local session, removed when its process ends."""
    root = tempfile.mkdtemp(prefix="haulmark-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared root for one run of one job."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
