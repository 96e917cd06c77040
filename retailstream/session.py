"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Configuration a job on a large cluster wants regardless of data size.  AQE
# re-plans joins at run time from real shuffle sizes (broadcast conversion of a
# side that turned out small, skewed-partition splitting, partition coalescing).
CLUSTER_DEFAULTS = {
    # Broadcast only what is proven small: no broadcast from planner *estimates*
    # (file sizes can understate in-memory size); AQE still turns a join into a
    # broadcast when the *measured* shuffle output of a side is under 32 MB, and
    # no operator hints a broadcast of its own.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "retailstream", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g")
         # one JVM with a large heap would otherwise size Tungsten pages at 64 MB,
         # and every small broadcast hash relation would allocate a full page
         .config("spark.buffer.pageSize", "4m"))
    for k, v in {**CLUSTER_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (HDFS/object-store) folder and is
    used as-is.  Only a plain local session may go without it (tests) and gets a
    temporary folder; anywhere else that folder could not be read by the other
    machines, so a missing setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="retailstream-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for stream checkpoints/tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
