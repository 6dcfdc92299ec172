"""Session helpers: a local session for tests/bench and checkpoint-dir lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "assetqueue") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ASSETQUEUE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder: the one the cluster names (``spark.checkpoint.dir``).

    Where none is named, a local session (one machine, as in tests) gets a
    temporary folder and a cluster gets none: a machine-local folder there would
    be lost with its executor.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named or sc.master.split("[")[0] == "local":
            sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="assetqueue-ckpt-"))
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once: checkpointed in the folder the cluster names, or cached where there is none."""
    return df.checkpoint() if checkpoint_dir(df.sparkSession) else df.persist()
