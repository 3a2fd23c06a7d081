"""Session construction and shared-storage paths.

On a cluster the session comes from the platform; ``build_session`` is for
local runs, tests and the benchmark.  Every path the library writes to for its
own bookkeeping (stream checkpoints, landing folders of the fixture flows,
lineage cuts) lives under ``spark.checkpoint.dir``, which on a cluster names a
shared folder that survives executor loss.  We only set that setting ourselves
when the session has none: under the run's storage root, or (local sessions only)
in a temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on for identical results on every deployment.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Dedup state can grow without bound (the source pipeline keeps every key it has
    # ever seen); RocksDB keeps it off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit only the changes of each micro-batch instead of state snapshots.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "stratum", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, root: str | None = None) -> str:
    """Return the shared checkpoint folder.

    The session's own setting wins; else a folder under ``root`` (a run's storage
    root) is used.  Only a local session may fall back to a temporary folder: on a
    cluster that would be one machine's disk, so it is refused.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if root:
            configured = f"{root.rstrip('/')}/_checkpoints"
        elif is_local(sc.master):
            configured = tempfile.mkdtemp(prefix="stratum-ckpt-")
        else:
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all "
                             f"executors share (master {sc.master})")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def is_local(master: str) -> bool:
    """Driver and executors are one process (not ``local-cluster``)."""
    return master == "local" or master.startswith("local[")


def shared_path(spark: SparkSession, *parts: str, fresh: bool = False) -> str:
    """A path under the shared checkpoint folder; ``fresh`` adds a unique leaf."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    leaf = [f"run-{uuid.uuid4().hex[:12]}"] if fresh else []
    return os.path.join(base, "stratum", *parts, *leaf)
