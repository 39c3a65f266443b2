"""Session construction and the shared scratch location.

Cluster jobs must never write to a machine-local folder: intermediate tables and
streaming checkpoints go under ``spark.checkpoint.dir``, which the cluster sets
to a shared file system. Only when it is unset (local tests) do we pick one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shoplens", extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf.setdefault("spark.driver.memory", os.environ.get("SHOPLENS_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # the binding and the oracle assume UTC wall-clock formatting
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    Reads ``spark.checkpoint.dir`` from the session and keeps its scheme (a path
    without one would be resolved against the cluster's default file system).
    Only a local session, where driver and executors share the disk, may leave it
    unset: a temporary folder is chosen then. On a cluster that would scatter the
    files over the executors' own disks, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder when the master is {master!r}")
        base = tempfile.mkdtemp(prefix="shoplens-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    Several results read it, a lost executor costs no recomputation, and unlike
    a checkpoint it keeps column pruning and size statistics for the planner.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
