"""Intermediate tables that later steps read more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. One is made only in local mode, where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="tallyhouse-llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """The rows of df, computed once, written to the shared folder and read back.

    Each call writes a folder of its own, so a retried or repeated run meets no leftovers, and a
    lost executor costs a re-read.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
