"""Saving an intermediate result that several later steps read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _use_checkpoint_folder(spark: SparkSession) -> None:
    """Use the folder of spark.checkpoint.dir. Only in local mode one is made where it is unset; on a
    cluster a missing setting is an error, as a folder of one machine would not be shared."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tallyhouse-")
    context.setCheckpointDir(folder)


def saved(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read back from the checkpoint folder.

    Losing an executor then costs a re-read, not a recomputation.
    """
    _use_checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path beside the checkpoints, seen by the driver and all executors."""
    _use_checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex[:12]}"
