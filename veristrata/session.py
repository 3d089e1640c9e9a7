"""Session helpers: a tuned local session, and the shared folder of the cluster."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def local_session(cpus: str | int = "*", app: str = "veristrata", memory: str = "12g") -> SparkSession:
    """A single-JVM session for tests and benchmarks. On a cluster use the session you are given."""
    parallelism = os.cpu_count() if str(cpus) == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parallelism))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Reports aggregate many columns at once; keep them in generated code.
        .config("spark.sql.codegen.maxFields", "1000")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it gets one temporary folder per application.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="veristrata-")
        context.setCheckpointDir(_LOCAL_DIRS[app])
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once under the shared folder and read back, so that later passes see the same ones and a lost
    executor costs no more than the step it was in."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_database(spark: SparkSession, name: str) -> str:
    """A fresh database whose managed tables live under the shared folder."""
    database = f"{name}_{uuid.uuid4().hex[:12]}"
    location = f"{shared_dir(spark)}/{database}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    return database
