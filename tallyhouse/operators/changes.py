"""Table changes as rewrites: merge, delete, update. Each returns the new table contents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update matched rows, insert new ones; columns as in the target.

    A matched row takes the source value even when that is NULL. Several source rows for one key
    stop the query, as they do in SQL. Keys are unique in the target; rows with a NULL key match nothing.
    """
    hit = "__in_source"
    keyed = _has_key(keys)
    incoming = _one_per_key(source.where(keyed), keys).withColumn(hit, F.lit(True)).alias("s")
    merged = target.where(keyed).alias("t").join(incoming, list(keys), "full")
    changed = set(source.columns)
    columns = [
        F.when(F.col(hit), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        if c in changed and c not in keys
        else F.col(c if c in keys else f"t.{c}")
        for c in target.columns
    ]
    # what has no key takes no part in the join, where all of it would meet in one task
    new = source.where(~keyed).select([c for c in target.columns if c in changed])
    return (
        merged.select(*columns)
        .unionByName(target.where(~keyed))
        .unionByName(new, allowMissingColumns=True)
    )


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _one_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source itself, whose keys are not NULL; running it fails if a key occurs twice.

    The window shares its partitioning with the join that follows.
    """
    times = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    message = F.lit(f"several source rows for one value of {', '.join(keys)}")
    checked = source.withColumn("__times", times)
    stop = F.raise_error(message).cast("boolean")
    return checked.where(F.when(F.col("__times") > 1, stop).otherwise(True)).drop("__times")


def delete_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the target rows whose key still exists in the source."""
    return target.join(source.select(*keys).distinct(), list(keys), "left_semi")


def full_sync(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge, then delete what the source no longer has.

    What is left are the source's rows; the target only lends the columns that the source lacks.
    Source rows with a NULL key go, as no key of theirs exists.
    """
    known = _one_per_key(source.dropna(subset=list(keys)), keys)
    lent = [c for c in target.columns if c not in source.columns]
    if lent:
        known = known.join(target.select(*keys, *lent), list(keys), "left")
    return known.select(*target.columns)


def update_by_key(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Replace the named columns of the rows that have an update (one per key)."""
    hit = "__updated"
    fresh = updates.select(*keys, *columns).withColumn(hit, F.lit(True)).alias("u")
    joined = target.alias("t").join(fresh, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col(hit), F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            if c in columns
            else F.col(c if c in keys else f"t.{c}")
            for c in target.columns
        ]
    )


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Delete rows for which the condition is true; unknown keeps the row."""
    return target.where(~F.coalesce(condition, F.lit(False)))


def truncate(target: DataFrame) -> DataFrame:
    return target.limit(0)
