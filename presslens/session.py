"""Session construction and shared-folder resolution."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job assumes: UTC wall clock (epoch-ms edges are UTC), AQE for
# runtime coalescing and skew-join splitting, Arrow for the pandas paths.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "presslens",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local-mode session with no setting gets a fresh folder of its own
    (tests, local bench); a cluster session without it is a configuration error,
    because a machine-local folder would not survive a lost executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="presslens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_dir(spark: SparkSession, name: str, fresh: bool = True) -> str:
    """A path under the shared checkpoint folder; a new one per call when ``fresh``."""
    root = _checkpoint_root(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "rdd"))
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if fresh else name
    return os.path.join(root, leaf)


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint (written to the shared folder), never a local one."""
    shared_dir(df.sparkSession, "rdd", fresh=False)
    return df.checkpoint(eager=eager)


MOST_SHUFFLE_PARTITIONS = 40_000  # the driver keeps a status of every map task for each of them


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int = 4, shuffled_share: float = 0.1,
                 target_partition_bytes: int = 256 * 1024 * 1024, scan_split_bytes: int = 1024 * 1024 * 1024) -> dict:
    """Settings for a cluster run over ``input_bytes`` of parquet.

    Shuffle partitions are sized for what is shuffled after projection, a ``shuffled_share`` of the input, at
    about one per ``target_partition_bytes``; never fewer than 2 waves of tasks nor more than
    MOST_SHUFFLE_PARTITIONS (AQE coalesces small ones and splits skewed ones at run time). Large scan splits keep the
    number of map tasks, and with it of shuffle blocks, in bounds.
    """
    slots = max(1, executors * cores_per_executor)
    wanted = int(input_bytes * shuffled_share // target_partition_bytes) + 1
    parts = min(MOST_SHUFFLE_PARTITIONS, max(2 * slots, wanted))
    return {
        **SESSION_DEFAULTS,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
