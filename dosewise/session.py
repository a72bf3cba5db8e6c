"""Spark session defaults for local runs and tests.

On a cluster the session comes from the platform; ``ensure_checkpoint_dir``
only fills ``spark.checkpoint.dir`` when the cluster left it unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins/partition counts at run
# time; skew-join splits hot keys (a single clinic or the catch-all id 0 can
# hold a large share of all lines).
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python call-site capture on every DataFrame/Column call
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Starting points for a large cluster (~100 TB of lines). Shuffle partitions
# are an upper bound that AQE coalesces down; 256 MB input splits and
# advisory partitions keep tasks in the seconds-to-a-minute range; skew-join
# thresholds split partitions five times the median and above 512 MB.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.dosewise.broadcastCapBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def apply_cluster_defaults(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply ``CLUSTER_DEFAULTS`` (plus overrides) to a running session.
    Operator-owned settings given at launch (present in the SparkConf) are
    left untouched."""
    launch = spark.sparkContext.getConf()
    for k, v in {**CLUSTER_DEFAULTS, **(overrides or {})}.items():
        if k not in (overrides or {}) and k in _CLUSTER_OWNED and launch.contains(k):
            continue
        spark.conf.set(k, v)


# settings a cluster operator typically owns; never overwritten when set
_CLUSTER_OWNED = {"spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"}


def get_session(app: str = "dosewise", cpus: int | str = "*", shuffle_partitions: int = 8,
                driver_memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    Clusters name a shared folder in ``spark.checkpoint.dir``; that setting
    wins. Local runs and tests get a fresh scratch folder; anywhere else a
    missing setting is an error, as executors share no local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="dosewise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current
