"""Planned catch-up: the borders of all coming batches of a source, found before the first is read.

A bounded batch found on its own costs a look at everything that is still unread. The plan looks twice in
all: once for a histogram of the rows by period, and once more at the periods that hold an n-th row,
2n-th row and so on. Each batch is then a range of the mark column and nothing else.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.joins import is_small
from tallyhouse.operators.lineage import saved
from tallyhouse.streaming.batches import Mark, newer_than

MOST_RANGES = 100  # periods that are written into the filter, so that a scan can skip the others


def _holds_border(seen: Column, rows: Column, n: int) -> Column:
    """Whether the ``rows`` that end at running count ``seen`` hold a row whose number n divides."""
    return F.floor(seen / n) > F.floor((seen - rows) / n)


def _running(df: DataFrame, window, before: Column) -> DataFrame:
    return df.withColumn("seen", before + F.sum("rows").over(window.rowsBetween(Window.unboundedPreceding, 0)))


def _only(rows: DataFrame, ts: str, periods: DataFrame, grain: str) -> DataFrame:
    """rows of the given periods, with their period; few periods also become a filter on the column itself."""
    kind = rows.schema[ts].dataType
    if periods.count() <= MOST_RANGES:
        width = F.expr(f"INTERVAL '1' {grain}")
        begins = [F.timestamp_micros(F.lit(p.begin)) for p in periods.select(F.unix_micros("period").alias("begin")).collect()]
        ranges = [(F.col(ts) >= b.cast(kind)) & (F.col(ts) < (b + width).cast(kind)) for b in begins]
        rows = rows.where(reduce(lambda a, b: a | b, ranges, F.lit(False)))
    near = F.broadcast(periods) if is_small(periods) else periods
    return rows.withColumn("period", F.date_trunc(grain, ts)).join(near, "period")


def plan_batches(df: DataFrame, ts: str, mark: Mark, n: int, grain: str = "HOUR") -> DataFrame:
    """(batch, after, upto, rows): ranges after < ts <= upto of the rows newer than the mark, in order.

    A batch ends with the timestamp of the n-th, 2n-th, ... row, and takes all rows that share it; the last one
    ends with the newest row. ``after`` is the border before, NULL for the first batch. Rows without a
    timestamp are in no batch. The result is saved; df is read twice.

    What a task sorts is bounded by the calendar: periods, the seconds of a period, the distinct times
    of a second.
    """
    fresh = newer_than(df, ts, mark).select(ts)
    counted = saved(fresh.groupBy(F.date_trunc(grain, ts).alias("period")).agg(F.count("*").alias("rows")))
    periods = _running(counted, Window.orderBy("period"), F.lit(0))
    newest = counted.agg(F.max("period").alias("newest"))
    last = F.col("period") == newest.scalar()
    held = periods.where(_holds_border(F.col("seen"), F.col("rows"), n) | last)
    held = saved(held.select("period", (F.col("seen") - F.col("rows")).alias("before")))

    second = F.date_trunc("SECOND", ts).alias("second")
    times = _only(fresh, ts, held, grain).groupBy("period", "before", second, ts).agg(F.count("*").alias("rows"))
    times = saved(times)
    end = times.agg(F.max(ts).alias("end")).scalar()
    seconds = times.groupBy("period", "before", "second").agg(F.sum("rows").alias("rows"))
    seconds = _running(seconds, Window.partitionBy("period").orderBy("second"), F.col("before"))
    last = F.col("second") == F.date_trunc("SECOND", end)
    seconds = seconds.where(_holds_border(F.col("seen"), F.col("rows"), n) | last).select(
        "second", (F.col("seen") - F.col("rows")).alias("earlier")
    )
    exact = _running(times.join(seconds, "second"), Window.partitionBy("second").orderBy(ts), F.col("earlier"))
    borders = exact.where(_holds_border(F.col("seen"), F.col("rows"), n) | (F.col(ts) == end))
    in_order = Window.orderBy(ts)  # one row for each batch
    return saved(
        borders.select(
            F.row_number().over(in_order).cast("bigint").alias("batch"),
            F.lag(ts).over(in_order).alias("after"),
            F.col(ts).alias("upto"),
            (F.col("seen") - F.coalesce(F.lag("seen").over(in_order), F.lit(0))).alias("rows"),
        ).orderBy("batch")
    )
