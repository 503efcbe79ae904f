"""Spark session settings used by tests, bench and the examples.

On a cluster the session comes from the platform; only the settings that the
library relies on are asserted here (UTC session zone, AQE).  A checkpoint
directory is read from ``spark.checkpoint.dir``; a scratch one is set only when
the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partial top-1 per key before the shuffle (WindowGroupLimit).
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, cpus: int | None = None,
                  shuffle_partitions: int | None = None, app: str = "cdc_lake",
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    b = SparkSession.builder.appName(app)
    if master or cpus:
        b = b.master(master or f"local[{cpus}]")
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster (``spark.checkpoint.dir``).  Where it is unset, a local master gets a
    scratch folder; a cluster, whose machines would not share one, is refused."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="cdc_lake_ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir
