"""First event on or after a date, last event before a date, as one sorted merge.

Days with events and anchors go into one stream, ordered by key and day and cut into runs by range, so a
busy key fills several runs. Inside a run the nearest event day is carried to the anchors by a window that
ignores nulls; a carry table with one row for each key in each run brings it over the borders of the runs.
Each key has a day once in the stream, however many events it has on it. The chosen days are then joined back
on (key, day), which spreads a busy key over its days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.joins import attach, is_small
from tallyhouse.operators.lineage import saved
from tallyhouse.operators.ranking import in_runs


def _merged(events: DataFrame, anchors: DataFrame, key: str, day: str, anchor: str) -> DataFrame:
    """(key, __day, __kind, __seen, __anchor) in runs; on a day the anchor comes before the events."""
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType)
    days = events.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, day).distinct()
    days = days.select(
        key, F.col(day).alias("__day"), F.lit(1).alias("__kind"), F.col(day).alias("__seen"), none(anchors, anchor).alias("__anchor")
    )
    points = anchors.where(F.col(key).isNotNull() & F.col(anchor).isNotNull()).select(key, anchor).distinct()
    points = points.select(
        key, F.col(anchor).alias("__day"), F.lit(0).alias("__kind"), none(events, day).alias("__seen"), F.col(anchor).alias("__anchor")
    )
    return in_runs(days.unionByName(points), [("__day", False), ("__kind", False)], [key])


def _nearest(events: DataFrame, anchors: DataFrame, key: str, day: str, anchor: str, forward: bool) -> DataFrame:
    """(key, anchor, day): the nearest day with events for every anchor that has one."""
    runs = _merged(events, anchors, key, day, anchor)
    inside = Window.partitionBy("__key", "__run").orderBy("__at")
    over = Window.partitionBy("__key").orderBy("__run")
    ends = runs.groupBy("__key", "__run")
    if forward:
        near = F.first("__seen", ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing))
        carry = ends.agg(F.min("__seen").alias("__end")).withColumn(
            "__carried", F.min("__end").over(over.rowsBetween(1, Window.unboundedFollowing))
        )
    else:
        near = F.last("__seen", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        carry = ends.agg(F.max("__seen").alias("__end")).withColumn(
            "__carried", F.max("__end").over(over.rowsBetween(Window.unboundedPreceding, -1))
        )
    carry = saved(carry.drop("__end"))
    placed = attach(runs.withColumn("__near", near), carry, ["__key", "__run"], broadcast=is_small(carry))
    return placed.where("__kind = 0").select(
        key, F.col("__anchor").alias(anchor), F.coalesce("__near", "__carried").alias(day)
    ).where(F.col(day).isNotNull())


def _at(events: DataFrame, nearest: DataFrame, key: str, day: str) -> DataFrame:
    nearest = saved(nearest)  # one row for each anchor
    return events.join(F.broadcast(nearest) if is_small(nearest) else nearest, [key, day])


def first_on_or_after(events: DataFrame, anchors: DataFrame, key: str, day: str, anchor: str) -> DataFrame:
    """All events on the earliest day that is not before the anchor (several on the same day)."""
    return _at(events, _nearest(events, anchors, key, day, anchor, True), key, day)


def last_before(events: DataFrame, anchors: DataFrame, key: str, day: str, anchor: str) -> DataFrame:
    """All events on the latest day strictly before the anchor."""
    return _at(events, _nearest(events, anchors, key, day, anchor, False), key, day)
