"""Shared folders for what a job writes on its way: checkpoints, stream states, stores of queries."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only in local mode without it."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="spark-driftline-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def allow_checkpoints(spark: SparkSession) -> None:
    """Name a folder for DataFrame.checkpoint() where the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def kept_table(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: lineage ends here, and what reads it twice makes it once."""
    path = scratch_path(df.sparkSession, "kept")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
