"""Duplicate removal on whole rows and on a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """One copy of every row, NULLs counted as equal; copies are merged before the shuffle."""
    return df.dropDuplicates()


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row of each key. ``newest_first`` must leave no ties to be repeatable.

    Spark keeps one candidate per key in every input task, so a key with many copies costs one
    row per task in the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("__age", F.row_number().over(window)).where("__age <= 1").drop("__age")
