"""Session construction and the shared folder used for stored results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants: AQE re-plans joins/partition counts from runtime
# sizes and splits skewed join partitions; the UI stays off (no server).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot partition even where joins on one key share a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files of staged frames once they are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_local_dirs: dict[int, str] = {}


def get_spark(master: str | None = None, app: str = "orderlens",
              conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and stored tables.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``.
    Only when that is unset and the master is local (tests) a fresh local
    folder is created and registered as the checkpoint dir; on a cluster an
    unset setting is an error, never a machine-local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured.rstrip("/")
        if not str(spark.conf.get("spark.master", "local")).startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        _local_dirs.setdefault(id(spark), tempfile.mkdtemp(prefix="orderlens-"))
        return _local_dirs[id(spark)]
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not str(sc.master).startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    key = id(sc._jsc)
    if key not in _local_dirs:
        _local_dirs[key] = tempfile.mkdtemp(prefix="orderlens-")
        sc.setCheckpointDir(_local_dirs[key] + "/checkpoints")
    return _local_dirs[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared dir (never reused, never cleared)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(largest_shuffle_bytes: int, target_partition_bytes: int = 256 << 20,
               min_partitions: int = 200) -> dict[str, str]:
    """Settings sized for the largest shuffle of a job (e.g. the line table of
    the order view), so no shuffle partition outgrows executor memory.

    Shuffle partitions = bytes / target; AQE then coalesces the
    smaller shuffles to the same advisory size and splits any partition more
    than 4x that size as skewed.  Scan splits use the same target, so a task
    reads, sorts and spills at most a few hundred MB.
    """
    n = -(-int(largest_shuffle_bytes) // int(target_partition_bytes))
    n = max(min_partitions, n)
    size = f"{int(target_partition_bytes) >> 20}m"
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * (int(target_partition_bytes) >> 20)}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }
