"""High-water batches: rows newer than a mark, oldest first, at most n of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A wall-clock time, an instant in microseconds since 1970 (UTC), or None for "from the start".
Mark = dt.datetime | int | None


def _mark(mark: dt.datetime | int, kind: str) -> Column:
    if isinstance(mark, int):
        return F.timestamp_micros(F.lit(mark)).cast(kind)
    return F.lit(mark.isoformat(sep=" ")).cast(kind)


def newer_than(df: DataFrame, ts: str, mark: Mark) -> DataFrame:
    """Rows strictly after the mark. Rows without a timestamp belong to no batch."""
    known = df.where(F.col(ts).isNotNull())
    if mark is None:
        return known
    return known.where(F.col(ts) > _mark(mark, df.schema[ts].dataType.simpleString()))


def between(df: DataFrame, ts: str, after: Mark, upto: Mark) -> DataFrame:
    """Rows after one mark, up to and with another; None leaves a side open.

    Both are compared with the stored column, so the scan of a file or a database can skip rows.
    """
    fresh = newer_than(df, ts, after)
    if upto is None:
        return fresh
    return fresh.where(F.col(ts) <= _mark(upto, df.schema[ts].dataType.simpleString()))


def without_timestamp(df: DataFrame, ts: str) -> DataFrame:
    """Rows no batch will ever pick up."""
    return df.where(F.col(ts).isNull())


def late_rows(df: DataFrame, ts: str, mark: Mark) -> Column:
    """True for rows at or below the mark, which no later batch reads."""
    if mark is None:
        return F.lit(False)
    return F.col(ts) <= _mark(mark, df.schema[ts].dataType.simpleString())


def _oldest(df: DataFrame, ts: str, n: int, grain: str) -> DataFrame:
    """A superset of the n oldest rows: those up to the end of the period holding the n-th row.

    Without it each of a large scan's tasks would offer n rows to the one task that picks the
    batch. Counting rows per period is a small aggregate (one row per period of the calendar), and
    the bound is a comparison on the stored column, which the file scan can use to skip data.
    """
    counts = df.groupBy(F.date_trunc(grain, ts).alias("__p")).agg(F.count("*").alias("__n"))
    running = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counts.withColumn("__seen", F.sum("__n").over(running))
    last_period = F.coalesce(F.min(F.when(F.col("__seen") >= n, F.col("__p"))), F.max("__p"))
    end = last_period + F.expr(f"INTERVAL '1' {grain}")
    bound = reached.agg(end.cast(df.schema[ts].dataType).alias("bound"))
    return df.where(F.col(ts) < bound.scalar())


def next_batch(
    df: DataFrame, ts: str, tie_break: Sequence[str], mark: Mark, n: int, grain: str = "HOUR"
) -> DataFrame:
    """Exactly the n oldest rows after the mark.

    Rows that share the last timestamp but did not fit are lost to later batches, because those
    start strictly after it. ``next_batch_whole`` does not have this problem.
    """
    fresh = newer_than(df, ts, mark)
    return _oldest(fresh, ts, n, grain).orderBy(ts, *tie_break).limit(n)


def next_batch_whole(df: DataFrame, ts: str, mark: Mark, n: int, grain: str = "HOUR") -> DataFrame:
    """The n oldest rows after the mark plus all rows that tie with the last of them."""
    fresh = newer_than(df, ts, mark)
    first_n = _oldest(fresh.select(ts), ts, n, grain).orderBy(ts).limit(n)
    cutoff = first_n.agg(F.max(ts).alias("cutoff"))
    return fresh.where(F.col(ts) <= cutoff.scalar())
