"""Grouping shapes: duplicate finder, pivot, set unions, daily totals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, columns: Sequence[str], name: str = "occurrences") -> DataFrame:
    """Value combinations that occur more than once, with their row counts."""
    return df.groupBy(*columns).agg(F.count("*").alias(name)).where(F.col(name) > 1)


MOST_PIVOT_VALUES = 1_000  # looked-up values, each of which becomes a column


def pivot_total(
    df: DataFrame,
    key: str,
    pivot: str,
    measure: str,
    values: Sequence[str] | None = None,
    rest: str = "other",
) -> DataFrame:
    """One column per value and one, named ``rest``, for NULL and all values not declared.

    Declaring the values fixes the schema and saves a job; without them they are looked up, in order. More than
    MOST_PIVOT_VALUES of them raise: such a column is a key, not a heading.
    """
    if values is None:
        found = df.select(F.col(pivot).cast("string")).where(F.col(pivot).isNotNull()).distinct()
        values = sorted((r[0] for r in found.limit(MOST_PIVOT_VALUES + 1).collect()), key=str.encode)
        if len(values) > MOST_PIVOT_VALUES:
            raise ValueError(f"{pivot} has more than {MOST_PIVOT_VALUES} values; declare those to show")
    if rest in values:
        raise ValueError(f"{rest!r} is a value of {pivot}; name the rest column otherwise")
    place = F.when(F.col(pivot).isin(list(values)), F.col(pivot).cast("string")).otherwise(rest)
    placed = df.withColumn("__place", place)
    return placed.groupBy(key).pivot("__place", [*values, rest]).agg(F.sum(measure))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def daily_total(df: DataFrame, day: str, amount: str, name: str = "total_sales") -> DataFrame:
    """The summary table a dashboard reads in place of re-adding every sale."""
    return df.groupBy(day).agg(F.sum(amount).alias(name))


def seed_if_empty(df: DataFrame, seed: DataFrame) -> DataFrame:
    """The table itself, or the starting rows when it has none."""
    return seed if df.isEmpty() else df
