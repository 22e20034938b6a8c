"""Session helpers: one place for the configs the plans rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str = "local[8]", app: str = "tessera", **extra: str) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    On a cluster, pass the cluster's own master and leave
    ``spark.checkpoint.dir`` to the cluster config.
    """
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master.startswith("local"):
        # local runs: one shuffle partition per core; clusters keep their own
        b = b.config("spark.sql.shuffle.partitions", master[6:-1] if master[6:-1].isdigit() else "8")
    for k, v in extra.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised stages.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a
    shared, fault-tolerant folder there). Where it is unset, a local
    session (tests) gets a scratch folder; a cluster session raises, as a
    machine-local folder would lose its files with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
