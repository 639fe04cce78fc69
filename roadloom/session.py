"""Session helpers: one place for the settings the operators rely on."""

from __future__ import annotations

import tempfile
import weakref

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every session should carry.  They are SQL confs, so they can also be
# applied to a session someone else built (see ``apply_sql_defaults``).  The
# operators do not depend on the session time zone (NTZ arithmetic is
# zone-free), so a foreign session keeps its own; our sessions use UTC.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "roadloom",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset so spark-submit decides; for local runs
    pass ``local[N]``.  The UI stays off: nothing here opens a web port.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    own = {"spark.sql.session.timeZone": "UTC", "spark.sql.sources.partitionOverwriteMode": "dynamic"}
    for key, value in {**SQL_DEFAULTS, **own, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_sql_defaults(spark: SparkSession) -> SparkSession:
    """Apply the SQL confs above to an existing session (idempotent)."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession, fallback_base: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster setting ``spark.checkpoint.dir`` wins.  Only when it is unset
    (local tests) a folder is created under ``fallback_base`` (or the system temp
    folder) and registered on the context.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = fallback_base or tempfile.gettempdir()
    path = tempfile.mkdtemp(prefix="roadloom-ckpt-", dir=base)
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def worked_out_once(df: DataFrame) -> DataFrame:
    """``df`` for a plan that uses it several times: its rows are kept on the executors' disks when the plan first runs.

    Nothing runs now.  A lost part is made anew from its source.  The rows go when the frame that `holding` ties to them does.
    """
    return df.persist(StorageLevel.DISK_ONLY)


def holding(result: DataFrame, *used: DataFrame) -> DataFrame:
    """``result``, with the kept rows of ``used`` given up when ``result`` is no longer referred to."""
    for df in used:
        weakref.finalize(result, _give_up, df).atexit = False
    return result


def _give_up(df: DataFrame) -> None:
    try:
        df.unpersist()
    except Exception:  # the session has ended, and its storage with it
        pass


def cluster_settings(
    shuffle_bytes: int,
    *,
    executors: int = 1000,
    cores_per_executor: int = 4,
    target_partition_bytes: int = 256 * 1024 * 1024,
    broadcast_bytes: int = 64 * 1024 * 1024,
    max_partitions: int = 200_000,
) -> dict[str, str]:
    """Settings for a large run, sized from the expected shuffle volume.

    ``shuffle_bytes`` is the largest stage's shuffle write (after column
    pruning and partial aggregation; for a full-table join or window it is
    about the projected size of that table).  Shuffle partitions are chosen so
    each reducer gets about ``target_partition_bytes`` (AQE then coalesces
    small ones and splits skewed ones), never fewer than two waves of the
    cluster's cores.  File splits use the same size, so a scan task and a
    reduce task hold similar amounts of data.  The broadcast threshold stays
    bounded: a side is broadcast only when its measured size is below it.
    """
    cores = executors * cores_per_executor
    partitions = min(max_partitions, max(2 * cores, -(-shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
    }
