"""Session settings and staging of shared intermediate tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "stockwave", cores: str | None = None, shared: str | None = None) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own. ``shared``: folder for staged tables."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return (builder.config("spark.checkpoint.dir", shared) if shared else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A session without that setting uses a folder of its own in the warehouse, which executors share too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def session_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/stockwave/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged; call it once no result that reads it is needed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(session_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so a table that several branches of a plan read (the daily panel, an item
    table) is computed once, survives lost executors, and reports its true size to the planner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
