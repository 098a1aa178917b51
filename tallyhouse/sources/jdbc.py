"""Relational databases over JDBC. Address and credentials always come from the caller."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sources.versions import VersionedTables


@dataclass(frozen=True)
class Split:
    """Parallel read: value range of a numeric, date or timestamp column cut into equal parts."""

    column: str
    lower: str
    upper: str
    parts: int


@dataclass(frozen=True)
class Newer:
    """Rows whose column is above a mark, and not above ``upto`` if that is given, both written as the database compares it; no mark means all.

    The database applies it, so a run that catches up batch by batch is not sent old rows again.
    """

    column: str
    mark: str | None
    upto: str | None = None


def rows_query(table: str, newer: Newer | None = None) -> str:
    bounds = []
    if newer is not None:
        for sign, mark in ((">", newer.mark), ("<=", newer.upto)):
            if mark is not None:
                text = mark.replace("'", "''")
                bounds.append(f"{newer.column} {sign} '{text}'")
    return f"SELECT * FROM {table}" + (f" WHERE {' AND '.join(bounds)}" if bounds else "")


def utc_text(micros: int) -> str:
    """A mark as most databases write a timestamp."""
    instant = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)
    return instant.isoformat(sep=" ", timespec="microseconds")


def ranged_reader(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    column: str,
    text: Callable[[int], str] = utc_text,
) -> Callable[[int | None, int | None], DataFrame]:
    """A function of two marks that has the database send the rows after one and up to the other only.

    ``text`` writes a mark (microseconds since 1970, UTC) as the column holds it; the order of these texts
    has to be that of the times.
    """

    def read(after: int | None, upto: int | None) -> DataFrame:
        bounds = (None if m is None else text(m) for m in (after, upto))
        return read_table(spark, url, table, properties, newer=Newer(column, *bounds))

    return read


def read_options(
    url: str, relation: str, properties: Mapping[str, str], split: Split | None = None
) -> dict[str, str]:
    options = {"url": url, "dbtable": relation, **properties}
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.parts),
        }
    return options


def as_relation(query: str) -> str:
    return f"({query}) AS t"


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split: Split | None = None,
    newer: Newer | None = None,
) -> DataFrame:
    """A table, or its rows above a mark, as a DataFrame; without a split one task reads all of it.

    Filters on stored columns reach the database, filters on computed ones do not.
    """
    relation = as_relation(rows_query(table, newer))
    return spark.read.format("jdbc").options(**read_options(url, relation, properties, split)).load()


def write_table(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], connections: int = 8
) -> None:
    """Replace the rows of a table and keep its definition; few connections at a time."""
    df.coalesce(connections).write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=table, truncate="true", **properties
    ).save()


def publish(
    store: VersionedTables, targets: Mapping[str, str], url: str, properties: Mapping[str, str]
) -> list[str]:
    """Send committed tables (table name -> database table); returns those without data yet."""
    missing = []
    for table, target in targets.items():
        df = store.read(table)
        if df is None:
            missing.append(table)
        else:
            write_table(df, url, target, properties)
    return missing
