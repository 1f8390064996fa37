"""SparkSession settings for the rollup jobs.

Two profiles:

* ``local`` -- tests and the bench on one machine (``local[N]``); few shuffle
  partitions, UI off, UTC session clock.
* ``cluster`` -- the shape we want on a large cluster: AQE on, with partition
  coalescing and skew-join splitting, a large initial shuffle partition count
  that AQE shrinks to the advisory size, and scan splits sized to executor
  memory. Nothing here names a cluster; values are conf defaults a deployment
  can override on spark-submit.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every profile shares: deterministic clock, AQE, skew handling.
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sort-merge joins whose one side is small at run time become broadcast
    # joins; a static threshold still guards the plan-time choice.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

CLUSTER_CONF = {
    # AQE starts from many partitions and merges them to ~256 MB each.
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.parquet.filterPushdown": "true",
    # A month's orders may exceed the default 10 MB creation side; let the
    # runtime bloom filter still prune the full-history fulfilment scans.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
}


def local_conf(cores: int | str = "*", shuffle_partitions: int = 8) -> dict[str, str]:
    conf = dict(COMMON_CONF)
    conf.update(
        {
            "spark.master": f"local[{cores}]",
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": os.environ.get("SHELFCOST_DRIVER_MEMORY", "16g"),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
        }
    )
    return conf


def build_session(profile: str = "local", cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "shelfcost", extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session configured for ``profile``."""
    if profile == "local":
        conf = local_conf(cores, shuffle_partitions)
    elif profile == "cluster":
        conf = dict(COMMON_CONF)
        conf.update(CLUSTER_CONF)
    else:
        raise ValueError(f"unknown profile {profile!r}")
    if extra:
        conf.update(extra)
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and job-owned tables.

    Uses ``spark.checkpoint.dir`` from the session (the cluster's shared,
    reliable folder). Only a local-mode session without that setting -- tests,
    the bench -- gets a fresh scratch folder; on a cluster a missing setting is
    an error, never a machine-local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local SparkContext
        sc = None
    if sc is not None:
        path = path or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    master = sc.master if sc is not None else (spark.conf.get("spark.master", None) or "")
    if not path:
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="shelfcost-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries planned in this block delete their shuffle files as they end.

    A session keeps them until its driver happens to collect garbage, so the disk of a job of many steps would hold all
    steps at once. For steps whose result is written or checkpointed, so that nothing reads their shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
