"""Data-quality rules that report failing rows instead of stopping at the first failure.

All row-level rules of a table and one uniqueness rule share one aggregation; each further uniqueness
rule adds a grouped count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(Exception):
    """Raised after all tables were checked, naming every table with a failed rule."""


@dataclass(frozen=True)
class MinRows:
    count: int = 1


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class HasType:
    column: str
    type_name: str


Rule = MinRows | NotNull | Unique | HasType


def key_rules(*columns: str) -> list[Rule]:
    """Primary key: no NULL in any part, no repeated combination."""
    return [*[NotNull(c) for c in columns], Unique(columns)]


def _report(df: DataFrame, table: str, rows: list) -> DataFrame:
    cells = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            failed.cast("bigint").alias("failed_rows"),
            (failed == 0).alias("success"),
        )
        for rule, failed in rows
    ]
    return df.select(F.inline(F.array(*cells)))


def _row_rules(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    aggregates, rows = [], []
    for i, rule in enumerate(rules):
        name = f"__r{i}"
        if isinstance(rule, MinRows):
            aggregates.append(F.greatest(rule.count - F.count("*"), F.lit(0)).alias(name))
            rows.append((f"min_rows({rule.count})", F.col(name)))
        elif isinstance(rule, NotNull):
            aggregates.append(F.count_if(F.col(rule.column).isNull()).alias(name))
            rows.append((f"not_null({rule.column})", F.col(name)))
        elif isinstance(rule, HasType):
            right = df.schema[rule.column].dataType.simpleString() == rule.type_name
            bad = F.lit(0) if right else F.count("*")
            aggregates.append(bad.alias(name))
            rows.append((f"has_type({rule.column},{rule.type_name})", F.col(name)))
    return _report(df.agg(*aggregates), table, rows)


def _unique_rule(df: DataFrame, rule: Unique, table: str) -> DataFrame:
    """Counts every row of a repeated key; rows whose key is NULL throughout are left to NotNull."""
    some_key = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in rule.columns])
    repeated = (
        df.where(some_key).groupBy(*rule.columns).agg(F.count("*").alias("__n")).where("__n > 1")
    )
    failed = repeated.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__failed"))
    return _report(failed, table, [(f"unique({','.join(rule.columns)})", F.col("__failed"))])


def _one_pass(df: DataFrame, rules: Sequence[Rule], unique: Unique, table: str) -> DataFrame:
    """All row rules and one uniqueness rule from one grouping by its key: the table is read once."""
    nulls = {r.column: F.count_if(F.col(r.column).isNull()) for r in rules if isinstance(r, NotNull)}
    per_key = df.groupBy(*unique.columns).agg(
        F.count("*").alias("__n"), *[n.alias(f"__null_{c}") for c, n in nulls.items()]
    )
    some_key = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in unique.columns])
    repeated = F.when(some_key & (F.col("__n") > 1), F.col("__n"))
    added = {"__rows": F.col("__n"), "__repeated": repeated}
    added |= {f"__null_{c}": F.col(f"__null_{c}") for c in nulls}
    totals = per_key.agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in added.items()])
    rows = []
    for rule in rules:
        if isinstance(rule, MinRows):
            missing = F.greatest(rule.count - F.col("__rows"), F.lit(0))
            rows.append((f"min_rows({rule.count})", missing))
        elif isinstance(rule, NotNull):
            rows.append((f"not_null({rule.column})", F.col(f"__null_{rule.column}")))
        elif isinstance(rule, HasType):
            right = df.schema[rule.column].dataType.simpleString() == rule.type_name
            bad = F.lit(0) if right else F.col("__rows")
            rows.append((f"has_type({rule.column},{rule.type_name})", bad))
        elif rule == unique:
            rows.append((f"unique({','.join(rule.columns)})", F.col("__repeated")))
    return _report(totals, table, rows)


def validate(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """(table_name, rule, failed_rows, success), one row per rule.

    With a uniqueness rule, its grouping answers all other rules as well; only further uniqueness
    rules read the table again.
    """
    if not rules:
        raise ValueError(f"no rules for {table}")
    unique = [r for r in rules if isinstance(r, Unique)]
    if not unique:
        return _row_rules(df, rules, table)
    parts = [_one_pass(df, rules, unique[0], table)]
    parts += [_unique_rule(df, r, table) for r in unique[1:] if r != unique[0]]
    return reduce(DataFrame.unionByName, parts)


def validate_all(
    tables: Mapping[str, DataFrame | None], suites: Mapping[str, Sequence[Rule]]
) -> DataFrame:
    """Check every table that exists; a missing one (None) is skipped."""
    parts = [
        validate(tables[name], rules, name)
        for name, rules in suites.items()
        if tables.get(name) is not None
    ]
    return reduce(DataFrame.unionByName, parts)


def foreign_key(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, table: str
) -> DataFrame:
    """Child rows that point at no parent; a NULL reference is allowed.

    References are counted per value first, so the anti join sees each value once.
    """
    used = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("__k")).agg(
        F.count("*").alias("__n")
    )
    orphans = used.join(parent.select(F.col(pk).alias("__k")), "__k", "left_anti")
    failed = orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__failed"))
    return _report(failed, table, [(f"references({fk})", F.col("__failed"))])


def assert_all(report: DataFrame) -> None:
    """Raise once, with the names of all tables that failed (one row per rule is collected)."""
    failed = sorted({r.table_name for r in report.where("NOT success").collect()})
    if failed:
        raise QualityError("quality rules failed for: " + ", ".join(failed))
