"""Session construction and the shared folders the library writes to.

Cluster rules followed here:

* The checkpoint folder is whatever the cluster names in ``spark.checkpoint.dir``.
  We only pick one ourselves when the session has none (local tests).
* Broadcasts are never decided from file-size estimates: the static threshold is
  off, and only AQE (which measures the real shuffle output) or an explicit,
  size-checked hint (``strata.operators.bounded``) may broadcast.
* AQE skew-join splitting is on, so a customer / key that holds a third of the
  rows is split across tasks instead of landing in one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Defaults applied by build_session(); runtime SQL confs only, safe on any cluster.
SQL_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # no broadcast from static estimates; AQE decides from measured shuffle sizes
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master`` is only set when given; under spark-submit the cluster decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    confs = dict(SQL_DEFAULTS)
    confs["spark.ui.enabled"] = "false"
    confs["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    confs.update(extra or {})
    for key, value in confs.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate() may hand back an existing session: re-apply the runtime SQL confs.
    for key, value in confs.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    if not shuffle_partitions:
        size_shuffles(spark)
    checkpoint_root(spark)
    return spark


def size_shuffles(spark: SparkSession, per_core: int = 4) -> int:
    """Start every shuffle with enough partitions for the cluster; AQE coalesces.

    Uses ``per_core`` partitions per task slot (at least ``spark.sql.shuffle.partitions``)
    as AQE's initial partition number, so a multi-terabyte shuffle is not squeezed
    into the default 200 partitions while small stages are merged back to the
    advisory size (64 MB).
    """
    slots = spark.sparkContext.defaultParallelism
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    initial = max(current, per_core * slots)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial))
    return initial


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the SparkContext or ``spark.checkpoint.dir``. Only a local master may
    have neither: then a folder under the warehouse directory is chosen. On a cluster
    that folder could be on one machine, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        configured = warehouse.rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder name under the shared checkpoint folder (not created here)."""
    return "/".join([checkpoint_root(spark), "strata", *parts, uuid.uuid4().hex])

