"""Join shapes used across the plans.

Every helper reduces the repeated side before it is shuffled, so a key that holds a large
share of the rows arrives at the join as one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A table within both bounds fits the memory of every task with room to spare.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 32


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the table has at most ``rows`` rows and BROADCAST_BYTES of values, measured now.

    The table is read for it: pass a stored one, or columns that are cheap to read.
    """
    width = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    size = F.sum(reduce(lambda a, b: a + b, width, F.lit(_ROW_BYTES)))
    n, total = df.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return n <= rows and total <= BROADCAST_BYTES


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """The table marked for broadcast when it is small, else None."""
    return F.broadcast(df) if is_small(df, rows) else None


def attach(
    df: DataFrame, lookup: DataFrame, on: Sequence[str], broadcast: bool = False
) -> DataFrame:
    """Add the columns of a lookup that has one row per key; NULL keys match NULL keys.

    The lookup is unique per key, so a hot key is heavy on one side only, and adaptive execution
    splits its partition. ``broadcast=True`` is for lookups whose size the caller has checked; it
    spares the other side its shuffle.
    """
    renamed = lookup.select(
        *[F.col(k).alias(f"__on_{k}") for k in on],
        *[c for c in lookup.columns if c not in on],
    )
    renamed = F.broadcast(renamed) if broadcast else renamed
    match = reduce(
        lambda a, b: a & b, [df[k].eqNullSafe(renamed[f"__on_{k}"]) for k in on]
    )
    return df.join(renamed, match, "inner").drop(*[f"__on_{k}" for k in on])


def without_match(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``left`` whose key (left name -> right name) never occurs in ``right``."""
    seen = right.select(*[F.col(r).alias(l) for l, r in on.items()]).distinct()
    return left.join(seen, list(on), "left_anti")


def self_lookup(
    df: DataFrame, ref: str, key: str, carry: dict[str, str], how: str = "inner"
) -> DataFrame:
    """Join a table to itself over a parent reference (employee to manager).

    Only rows that some other row points at can be on the parent side, so the table is first cut
    down to the referenced ids. When few parents hold most children the parent side is small.
    """
    referenced = df.where(F.col(ref).isNotNull()).select(F.col(ref).alias("__ref")).distinct()
    parents = df.select(
        F.col(key).alias("__ref"), *[F.col(c).alias(name) for c, name in carry.items()]
    ).join(referenced, "__ref", "left_semi")
    return df.join(parents, df[ref] == parents["__ref"], how).drop("__ref")


def pair_with(df: DataFrame, name: str, values: Sequence[object]) -> DataFrame:
    """Cartesian product with a short declared list: every row meets every value.

    The list is part of the plan, so the product costs no shuffle and grows with ``df`` alone.
    """
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))

