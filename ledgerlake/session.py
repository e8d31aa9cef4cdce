"""Session helpers: building a local session for tests/bench, and the shared scratch root.

On a cluster the shared folder comes from `spark.checkpoint.dir`; a local folder is only
created when that setting is unset (tests, local runs).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings the operators are designed around on a large cluster (merge into the job's conf;
# values are starting points for ~100 TB inputs on ~1000 executors, tune per workload).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "8000",  # upper bound; AQE coalesces small ones
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # spark.checkpoint.dir: a shared folder (HDFS / object store) named by the cluster
}


def local_session(cpus: int | str = "*", app: str = "ledgerlake", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root; create a local one only if none is configured."""
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return spark.sparkContext.getCheckpointDir() or current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # some deployments refuse runtime changes of core settings
        pass
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for files a job writes and re-reads."""
    import uuid

    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/ledgerlake-{name}-{uuid.uuid4().hex[:12]}"
