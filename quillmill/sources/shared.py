"""The folder that all executors share, and results kept there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir, or a new one where that is unset and the master is local (tests)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        sc.setCheckpointDir(found or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors reach."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder: for results that several branches or jobs use."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if(df: DataFrame, row_bytes: int, most: int = 32 << 20) -> DataFrame:
    """df, to be broadcast if its rows of row_bytes each come to no more than `most` bytes (df should be a cut, as it is counted);
    else df as it is, for a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= most else df
