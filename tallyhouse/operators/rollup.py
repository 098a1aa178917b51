"""Rollups kept up to date from increments, so that history is never read again.

``Rollup`` holds sums and counts: a stored total plus the total of new rows is the total of all rows.
``DistinctCount`` holds a sketch of the values seen: a value that comes again, in this batch or a later one,
changes nothing, and neither does a batch that is merged twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_COUNT = "*"


@dataclass(frozen=True)
class Rollup:
    """``measures`` maps an output column to the summed input column, or to ROW_COUNT."""

    name: str
    keys: tuple[str, ...]
    measures: Mapping[str, str]

    def delta(self, rows: DataFrame) -> DataFrame:
        """Totals of the given rows only."""
        return rows.groupBy(*self.keys).agg(
            *[
                (F.count("*") if source == ROW_COUNT else F.sum(source)).alias(out)
                for out, source in self.measures.items()
            ]
        )

    def merge(self, state: DataFrame | None, delta: DataFrame) -> DataFrame:
        """Stored totals plus the totals of new rows."""
        if state is None:
            return delta
        return add_up(state.unionByName(delta), self.keys, list(self.measures))


@dataclass(frozen=True)
class DistinctCount:
    """How many different values of ``counted`` each group has, as a mergeable sketch of fixed size.

    A sketch has 2**log_k places (at most 2**log_k bytes, less for few values); its standard error is about
    0.8 / sqrt(2**log_k), 0.3 % for 16. NULL is not a value.
    """

    name: str
    keys: tuple[str, ...]
    counted: str
    log_k: int = 16

    def delta(self, rows: DataFrame) -> DataFrame:
        """(keys, sketch) of the given rows only."""
        return rows.groupBy(*self.keys).agg(F.hll_sketch_agg(self.counted, F.lit(self.log_k)).alias("sketch"))

    def merge(self, state: DataFrame | None, delta: DataFrame) -> DataFrame:
        """The sketches of all values in state or delta."""
        if state is None:
            return delta
        both = state.unionByName(delta).groupBy(*self.keys)
        return both.agg(F.hll_union_agg("sketch").alias("sketch"))

    def estimate(self, state: DataFrame, name: str = "distinct_count") -> DataFrame:
        """(keys, estimate). It depends on the values seen only, not on the order of merges: a sketch that was
        never merged remembers its order of arrival, which the union with itself takes away."""
        plain = F.hll_union("sketch", "sketch")
        return state.select(*self.keys, F.hll_sketch_estimate(plain).alias(name))


def add_up(partials: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return partials.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
