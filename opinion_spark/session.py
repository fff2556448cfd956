"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every plan in this package.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Post-shuffle stages here are CPU-heavy (regex, array expressions), so
    # AQE may coalesce only down to ~one partition per core, not to 1 MB.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "opinion_spark") -> SparkSession:
    """Return the active session, or build a local one with sane defaults.

    On a cluster the submitter's session already exists and is returned
    untouched apart from the AQE flags (they are runtime-settable).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and materialised tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session,
    whose driver and executors are one process, may go without: it gets a
    scratch folder of its own, once. Any other session without the setting
    is an error, because a machine-local folder would lose files.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="opinion-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir
