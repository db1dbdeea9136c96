"""SparkSession construction and lineage-cut helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces small
# shuffle partitions at runtime; skew-join splits hot keys.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # No broadcast from plan-time size estimates (they can be far off after
    # filters and aggregates); AQE converts a join to broadcast only from the
    # measured size of a finished shuffle stage. Explicit broadcast() is used
    # only for fixed-size dimensions (nations, regions, the source blacklist).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # Shuffle partitions are coalesced at runtime towards this size; start high on
    # a cluster (spark.sql.adaptive.coalescePartitions.initialPartitionNum).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # Keyed streaming state (first usable snapshot per question) in RocksDB:
    # state larger than memory spills to local disk and is checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "vendorscope", extra: dict | None = None) -> SparkSession:
    """Return a session with the engine defaults (local master only when asked)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    # On one machine a table is often a single file of one row group, which a scan cannot split: text work is dealt to all cores.
    # A cluster's tables come in many files; there the scan's own splits are kept and nothing is shuffled.
    cores = re.fullmatch(r"local\[(\d+|\*)\]", master or "")
    if cores:
        builder = builder.config("spark.vendorscope.textTasks", str(os.cpu_count() or 1) if cores[1] == "*" else cores[1])
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A folder of our own is set only when the session names none and driver and
    executors are one process (local tests); on a cluster that is an error.
    """
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if not current.isDefined():
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="vendorscope-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
