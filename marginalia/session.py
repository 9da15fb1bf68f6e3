"""Session helpers: one place for the settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "marginalia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, AQE and skew-join splitting switched on.

    On a cluster the master, the shuffle width and the checkpoint folder come from
    spark-submit; only settings that change results or plans are pinned here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench."""
    return build_session(
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "12g"),
            "spark.ui.enabled": "false",
        },
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only when that is unset on a
    local master is a temporary folder made; on a cluster its absence is an error,
    since a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
