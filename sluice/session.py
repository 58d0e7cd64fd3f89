"""Session construction and the shared work folder.

Written tables (targets, state tables, stream sinks and checkpoints) live
under the folder the cluster names in ``spark.checkpoint.dir``.  We read that
setting from the session and only set our own when it is unset (local runs
and tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# shuffle partitions at runtime, and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Remove reliable-checkpoint files from the shared folder once the
    # checkpointed DataFrame is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int | None = None,
                  app: str = "sluice", driver_memory: str | None = None) -> SparkSession:
    """A session with the settings that matter at scale; what is not given stays as the cluster has it."""
    builder = (SparkSession.builder.appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    given = {"spark.master": master, "spark.sql.shuffle.partitions": shuffle_partitions,
             "spark.driver.memory": driver_memory}
    for k, v in given.items():
        if v is not None:
            builder = builder.config(k, str(v))
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            # A machine-local folder is not visible to other executors.
            raise RuntimeError("set spark.checkpoint.dir to a folder on the cluster's shared file system")
        # Unset in a local run or test: a temporary folder on this machine is shared by all tasks.
        conf_dir = tempfile.mkdtemp(prefix="sluice-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for one call under the shared checkpoint folder, removed when the session's JVM ends."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sluice"
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
    return f"{base}/{label}-{uuid.uuid4().hex[:12]}"
