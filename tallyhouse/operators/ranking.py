"""Ranks, row numbers, tiles, top-k and group statistics that do not pile up in one task.

A plain window sends all rows of a group to one task, and all rows of the table when there is no
group. The rank operators deal rows out by range on the complete order, groups first, so that every
task holds a run of neighbouring rows, whatever their type and however large a group is. Rows are
numbered inside their run; a tally of each group in each run, added up over the runs before it, says
where the run begins. The dealt rows are saved, so that a retried task meets the same runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.joins import attach, is_small
from tallyhouse.operators.lineage import saved

_EARLIER = (Window.unboundedPreceding, -1)


def _sorted(c: str, descending: bool) -> Column:
    return F.col(c).desc() if descending else F.col(c).asc()


def _packed(keys: Sequence[str]) -> Column:
    """The group as one value that is never NULL, so windows and joins on it share a partitioning."""
    return F.struct(*keys) if keys else F.lit(0)


def in_runs(df: DataFrame, order: Sequence[tuple[str, bool]], keys: Sequence[str] = ()) -> DataFrame:
    """The rows, saved, dealt out by range of group and order, with ``__key``, ``__run`` and ``__at``.

    Runs are numbered in the order of the range they hold; ``__at`` grows along the order over all
    runs. A group goes over as many runs as it fills. Rows that are equal in all columns of the order
    are in one run: rank such rows by value, not one by one.
    """
    columns = [*[F.col(k).asc() for k in keys], *[_sorted(c, d) for c, d in order]]
    dealt = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    numbered = dealt.withColumns({"__at": F.monotonically_increasing_id(), "__key": _packed(keys)})
    # the upper bits of the id are the number of the partition
    return saved(numbered.withColumn("__run", F.shiftright("__at", 33).cast("int")))


def run_tallies(runs: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """For each group in each run: ``__first``, each measure, ``<measure>_before`` (of its earlier runs)
    and ``<measure>_all`` (of the whole group). A row for each run and one for each group at most."""
    tallies = runs.groupBy("__key", "__run").agg(
        F.min("__at").alias("__first"), *[m.alias(name) for name, m in measures.items()]
    )
    group = Window.partitionBy("__key")
    earlier = group.orderBy("__run").rowsBetween(*_EARLIER)
    return tallies.withColumns(
        {f"{m}_before": F.coalesce(F.sum(m).over(earlier), F.lit(0)) for m in measures}
        | {f"{m}_all": F.sum(m).over(group) for m in measures}
    )


def _with_tallies(runs: DataFrame, measures: dict[str, Column]) -> DataFrame:
    tallies = saved(run_tallies(runs, measures))
    return attach(runs, tallies, ["__key", "__run"], broadcast=is_small(tallies))


def with_rank(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    name: str = "rank",
    descending: bool = True,
    dense: bool = False,
    save: bool = False,
) -> DataFrame:
    """Add the rank (or dense rank) of ``value`` inside each group; no keys ranks the table.

    Distinct values are ranked, with the number of their rows, and joined once; a value that many rows
    share is one of them. The input is read three times: ``save=True`` stores a computed one first.
    """
    df = saved(df) if save else df
    values = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    runs = in_runs(values, [(value, descending)], keys)
    placed = _with_tallies(runs, {"__rows": F.sum("__n"), "__values": F.count("*")})
    if dense:
        place = F.col("__values_before") + F.col("__at") - F.col("__first") + 1
    else:
        above = Window.partitionBy("__key", "__run").orderBy("__at").rowsBetween(*_EARLIER)
        place = F.col("__rows_before") + F.coalesce(F.sum("__n").over(above), F.lit(0)) + 1
    places = placed.select(*keys, value, place.cast("bigint").alias(name))
    return attach(df.drop(name), places, [*keys, value], broadcast=is_small(runs.select(*keys, value)))


def with_row_number(
    df: DataFrame, order: Sequence[tuple[str, bool]], keys: Sequence[str] = (), name: str = "row_number"
) -> DataFrame:
    """Number the rows of each group. ``order`` is (column, descending) and must be unique."""
    return _numbered(df, order, keys).withColumn(name, F.col("__rn")).select(
        *[c for c in df.columns if c != name], name
    )


def _numbered(df: DataFrame, order: Sequence[tuple[str, bool]], keys: Sequence[str]) -> DataFrame:
    """The rows with ``__rn``, their number, and ``__size``, that of the group."""
    placed = _with_tallies(in_runs(df, order, keys), {"__rows": F.count("*")})
    number = F.col("__rows_before") + F.col("__at") - F.col("__first") + 1
    return placed.withColumns({"__rn": number.cast("bigint"), "__size": F.col("__rows_all")})


def with_ntile(
    df: DataFrame,
    tiles: int,
    order: Sequence[tuple[str, bool]],
    keys: Sequence[str] = (),
    name: str = "ntile",
) -> DataFrame:
    """Split each group into ``tiles`` runs whose sizes differ by at most one, larger runs first."""
    numbered = _numbered(df, order, keys)
    small = F.floor(F.col("__size") / tiles)
    extra = F.col("__size") % tiles
    in_large = extra * (small + 1)
    rn = F.col("__rn")
    tile = F.when(rn <= in_large, F.ceil(rn / (small + 1))).otherwise(
        extra + F.ceil((rn - in_large) / F.greatest(small, F.lit(1)))
    )
    return numbered.withColumn(name, tile.cast("bigint")).select(*[c for c in df.columns if c != name], name)


def with_running_total(
    df: DataFrame,
    measure: str,
    order: Sequence[tuple[str, bool]],
    keys: Sequence[str] = (),
    name: str = "running_total",
) -> DataFrame:
    """Sum of a column over a row and all rows before it in its group; ``order`` must be unique."""
    placed = _with_tallies(in_runs(df, order, keys), {"__total": F.sum(measure)})
    upto = Window.partitionBy("__key", "__run").orderBy("__at")
    local = F.sum(measure).over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.when(local.isNull() & (F.col("__total_before") == 0), F.lit(None)).otherwise(
        F.col("__total_before") + F.coalesce(local, F.lit(0))
    )
    return placed.withColumn(name, total).select(*[c for c in df.columns if c != name], name)


def with_group_value(
    df: DataFrame, keys: Sequence[str], aggregate: Column, name: str
) -> DataFrame:
    """Add a group aggregate to every row, aggregating map-side first and joining it back.

    The totals are computed once and saved. With few groups they are broadcast, so the rows are not
    shuffled by a possibly hot key.
    """
    if not keys:
        return df.withColumn(name, df.agg(aggregate).scalar())
    totals = saved(df.groupBy(*keys).agg(aggregate.alias(name)))
    return attach(df, totals, keys, broadcast=is_small(totals))


def above_group_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows whose value exceeds the mean of their own group (rows without a group drop out)."""
    known = reduce(lambda d, k: d.where(F.col(k).isNotNull()), keys, df)
    return (
        with_group_value(known, keys, F.avg(value), "__mean")
        .where(F.col(value) > F.col("__mean"))
        .drop("__mean")
    )


def leaders(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows that hold the highest value of their group, ties kept.

    The rank filter lets Spark drop all but the local leaders before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    return df.withColumn("__place", F.rank().over(window)).where("__place <= 1").drop("__place")


def nth_values(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """The n-th highest distinct value of each group that has one."""
    window = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    return (
        df.select(*keys, value)
        .distinct()
        .withColumn("__place", F.dense_rank().over(window))
        .where(F.col("__place") <= n)
        .where(F.col("__place") == n)
        .drop("__place")
    )


def nth_value_rows(df: DataFrame, keys: Sequence[str], value: str, n: int) -> DataFrame:
    """All rows that hold the n-th highest distinct value of their group."""
    nth = saved(nth_values(df, keys, value, n))  # at most one value per group
    return attach(df, nth, [*keys, value], broadcast=is_small(nth))


def top_rows(df: DataFrame, value: str, tie_break: Sequence[str], k: int, skip: int = 0) -> DataFrame:
    """The k rows with the highest value after skipping some; the tie break fixes the choice."""
    ordered = df.orderBy(F.col(value).desc(), *tie_break)
    return (ordered.offset(skip) if skip else ordered).limit(k)
