"""Spark session helpers."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "objsync") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("OBJSYNC_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def app_id(spark: SparkSession) -> str:
    """The application id (also without a SparkContext, e.g. Spark Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no JVM context on this client
        return spark.conf.get("spark.app.id", "app")


def release_shuffles(spark: SparkSession) -> None:
    """Between the steps of a job: let Spark's cleaner drop the shuffle files of writes that are
    done, of which it learns when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster's ``spark.checkpoint.dir``.

    Only a ``local`` session without that setting (tests) gets a scratch
    folder; on a cluster the setting is required, because executors on other
    hosts would not see this host's folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="objsync-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()
