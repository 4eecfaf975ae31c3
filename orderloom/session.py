"""Spark session helpers.

Library code never creates its own session on a cluster; ``get_spark`` is for
tests, the bench and local runs.  ``checkpoint_dir`` reads the cluster's
``spark.checkpoint.dir`` and only invents a scratch folder where it is unset
(local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the pipeline relies on for correct results.
REQUIRED_CONF = {
    # All event-time arithmetic is done on zone-free timestamps; UTC keeps
    # casts to TIMESTAMP (e.g. in to_json output) stable.
    "spark.sql.session.timeZone": "UTC",
}

# Settings that matter for the plans at scale.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that needs one more shuffle
    # before the aggregate that follows (the versions assembly).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Dynamic overwrite: re-running a run rewrites only its own partitions.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "orderloom", extra: dict | None = None) -> SparkSession:
    """Local/test session with the settings the library expects."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": os.environ.get("ORDERLOOM_DRIVER_MEMORY", "8g"),
        **REQUIRED_CONF,
        **TUNING_CONF,
        **(extra or {}),
    }
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Uses ``spark.checkpoint.dir`` when the cluster names one; only a local
    master gets a fresh scratch folder.  On a cluster without the setting this
    is an error: executors would write to their own disks.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if not spark.sparkContext.master.startswith("local") or \
            spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="orderloom-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
