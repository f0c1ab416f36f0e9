"""Session helpers: builder for local runs and reliable checkpoints."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", name: str = "foliograph", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where it lies.

    A cluster has it installed or shipped with ``--py-files``; this covers runs
    from a checkout, whatever their working directory.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session: ``spark.checkpoint.dir``, or else a folder in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once, so later scans read it back."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)
