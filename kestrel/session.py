"""Spark session settings shared by tests, bench and the driver entry point.

On a cluster the session already exists; ``configure`` only fills in settings that
are still unset, so cluster-wide choices (shuffle partitions, checkpoint dir) win.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on for exact results.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Performance defaults, applied only where the cluster has not chosen a value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the join's partitioning feeds an aggregate (q4, q9).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows of long texts go to the workers few at a time: a task holds several copies of a batch.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
    # Broadcast only below a fixed size: AQE re-checks the real size at runtime.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "kestrel") -> SparkSession:
    """Local session for tests and benchmarks (UI off, no servers)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in {**DEFAULTS, **REQUIRED}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED.items():
        spark.conf.set(k, v)
    for k, v in DEFAULTS.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static conf on a running session: leave it
            pass
    return spark


_local_root: str | None = None


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, the folder that driver and executors share.

    Only a local session without that setting (tests) gets a folder of its own, one a process; a
    cluster must name one, because files in one machine's folder are lost to the others.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root = _local_root or tempfile.mkdtemp(prefix="kestrel-shared-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
