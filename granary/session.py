"""Spark session defaults used by the tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None, app: str = "granary") -> SparkSession:
    """A local session with adaptive execution on, UTC time and as many shuffle partitions as cores."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    """One input table; Parquet column pruning and filter pushdown follow from the plan above it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _local_folder() -> str:
    path = tempfile.mkdtemp("granary")
    atexit.register(shutil.rmtree, path, True)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which the driver and all executors share; only in local mode may it be unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named or _local_folder()


def cut(df: DataFrame) -> DataFrame:
    """The rows of df without their lineage, in the shared folder; the files go once nothing refers to the rows any more."""
    context = df.sparkSession.sparkContext
    context._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
