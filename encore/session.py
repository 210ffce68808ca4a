"""Session bootstrap and the reliable checkpoint location."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators are designed around: AQE re-plans joins from runtime
# sizes (a broadcast only happens below the measured threshold), splits skewed
# join partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "encore",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(shuffle_bytes: float, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizing for a cluster run, from the largest shuffle's size.

    AQE starts from ``initialPartitionNum`` partitions and merges them towards
    the advisory size, so the initial number is set high enough that each
    partition of the largest shuffle is about ``target_partition_bytes`` (fits
    an executor task's memory without spilling much), and never below two
    waves of the cluster's cores.
    """
    slots = executors * cores_per_executor
    partitions = max(2 * slots, int(shuffle_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names it in ``spark.checkpoint.dir`` (a shared file system).
    Only a local-mode session without one (tests, the bench) gets a fresh
    scratch directory; a cluster session without one is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder "
            "(HDFS/S3/...) so checkpointed stages survive executor loss")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="encore-ckpt-"))
    return sc.getCheckpointDir()
