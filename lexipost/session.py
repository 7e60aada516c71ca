"""Session defaults and the folder for staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}


def local_session(cores: str = "8", memory: str = "16g", app: str = "lexipost") -> SparkSession:
    """A single-machine session for tests and the bench, with a staging folder of its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="lexipost-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def stage_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir``.

    Only a session whose executor is the driver's own process, such as a test's, may go
    without the setting; it gets a temporary folder. Anywhere else executors could not
    all see such a folder, so an unset setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="lexipost-")
    return _own_dirs[app]


def new_stage_path(spark: SparkSession, label: str) -> str:
    return f"{stage_dir(spark)}/lexipost/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the staging folder and read it back.

    This cuts the lineage with a table that outlives any executor. A lost
    executor makes Spark re-read files, never redo the range sampling or the
    partition numbering behind them. Tables are packed by zstd, as disk and network cost more
    than its time.
    """
    spark = df.sparkSession
    path = new_stage_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
