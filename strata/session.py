"""Session construction and the shared scratch location.

On a cluster the scratch location is the folder named by ``spark.checkpoint.dir``
(shared storage every executor can reach). A folder is made only when it is unset
*and* the master is a single machine, which is the test and bench situation; everywhere
else an unset folder is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


# Settings of every session, and those that only suit one machine, where
# partitions are small: keep small shuffles parallel, split skewed partitions early.
COMMON = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
ONE_MACHINE = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # AQE may replace a sort-merge join by a shuffled hash join once it has measured
    # every build-side partition below this size; above it the sort-merge join stays.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def is_one_machine(spark: SparkSession) -> bool:
    """True for ``local`` and ``local[...]`` masters (not for ``local-cluster``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "strata", extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session; what the launcher configured stays as it is.

    No master is set unless one is given, so ``spark-submit``, ``spark-defaults.conf`` and
    the environment decide. The library's settings fill in only what is not configured:
    AQE and UTC everywhere, small-partition settings and one shuffle partition a core on a
    single machine. On a cluster, size shuffles with :func:`scale_settings`.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config(
            "spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    wanted = dict(COMMON)
    if is_one_machine(spark):
        wanted |= ONE_MACHINE | {"spark.sql.shuffle.partitions":
                                 str(spark.sparkContext.defaultParallelism)}
    apply_settings(spark, wanted, keep=[*(extra or {}), *(
        ["spark.sql.shuffle.partitions"] if shuffle_partitions else [])])
    return spark


def scale_settings(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20,
                   ) -> dict[str, str]:
    """Shuffle / scan sizing derived from the input size, for a cluster session.

    Initial shuffle partitions are sized so each holds ~``target_partition_bytes``
    of input (at least 2 waves of the cluster's cores); AQE then coalesces small
    ones and splits skewed join partitions. File splits use the same target.
    """
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(target_partition_bytes // 2),
    }


def apply_settings(spark: SparkSession, settings: dict[str, str],
                   keep: Iterable[str] = ()) -> dict[str, str]:
    """Set runtime SQL confs that the launcher left open (static ones such as memory must
    come from it); returns those that were set."""
    configured = spark.sparkContext.getConf()
    own = {k: v for k, v in settings.items() if k not in set(keep) and not configured.contains(k)}
    for k, v in own.items():
        spark.conf.set(k, v)
    return own


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the session; set a fresh local one only when unset on a local master.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get(_CKPT_KEY, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not is_one_machine(spark):
        raise RuntimeError(
            f"{_CKPT_KEY} is not set; on a cluster it must name a shared folder")
    path = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder (never reused)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, how: str = "checkpoint", path: str | None = None):
    """Cut the lineage of ``df`` so later jobs (and retries after a lost executor)
    start from stored data instead of recomputing upstream shuffles.

    ``checkpoint``: reliable checkpoint into the session's shared checkpoint folder;
    ``table``: write Parquet to ``path`` (default: a fresh shared folder) and read
    it back. Never a local checkpoint: executor-local blocks die with the executor.
    """
    spark = df.sparkSession
    if how == "checkpoint":
        checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    if how == "table":
        target = path or shared_dir(spark, "materialized")
        df.write.mode("overwrite").parquet(target)
        return spark.read.parquet(target)
    raise ValueError("how must be 'checkpoint' or 'table'")
