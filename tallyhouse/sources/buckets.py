"""A table kept by key, of which a change rewrites only the part it touches.

Rows lie in folders by a hash of their key. A step reads the folders that hold keys of its delta, merges, writes
the result beside the table and commits it; then Spark's dynamic partition overwrite replaces those folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, IntegerType, StructType

from tallyhouse.operators.lineage import saved
from tallyhouse.sources.storage import CommitLog, children, exists, remove

BUCKET = "__bucket"
FILES = 4  # a bucket is written by up to so many tasks, however many rows share a key

Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


class BucketedState:
    """Layout: ``<root>/data/__bucket=<n>/`` for rows, ``<root>/_commits/`` for records, ``<root>/staged-*`` meanwhile.

    Steps are numbered by the caller. A step that is committed is not taken again, so a replayed delta is added
    once; one that died while its folders were replaced is finished by the next ``read`` or ``apply``, from what
    it had staged. One writer at a time: a second one that commits the same record fails. A query that started on
    older files has to be done before a step replaces them.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 256):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), tuple(keys), buckets
        self.log = CommitLog(spark, f"{self.root}/_commits")
        self.data = f"{self.root}/data"

    def read(self) -> DataFrame | None:
        """The rows of the last committed step; None before the first."""
        _, record = self._settled()
        rows = self._rows(record)
        return rows if rows is None else rows.drop(BUCKET)

    def apply(self, step: int, delta: DataFrame, merge: Merge) -> list[int]:
        """Merge a delta into the folders its keys fall in and return their numbers; none if the step was taken.

        ``merge(state, delta)`` is given the rows of those folders (None before the first step) and returns their
        new contents. It may change or add rows of keys that the delta holds, and no others; rows may vanish.
        Columns and types stay those of the first step. NULL is a key like any other here.
        """
        number, record = self._settled()
        if step <= record.get("step", 0):
            return []
        schema = StructType.fromJson(record["schema"]) if record else None
        delta = saved(delta if schema is None else _typed(delta, schema))
        touched = sorted(r[0] for r in delta.select(self._bucket().alias(BUCKET)).distinct().collect())
        if not touched:  # at most self.buckets numbers are collected, no keys
            return []
        held = self._rows(record)
        if held is not None:
            held = held.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = merge(held, delta)
        merged = merged if schema is None else _typed(merged, schema)
        staged = f"staged-{step}-{uuid.uuid4().hex[:12]}"
        self._write_staged(merged, staged)
        facts = {"step": step, "buckets": self.buckets, "schema": merged.schema.jsonValue()}
        self.log.commit(number + 1, {**facts, "staged": staged, "touched": touched})
        self._settled()
        return touched

    def _bucket(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")

    def _rows(self, record: dict) -> DataFrame | None:
        if not record:
            return None
        schema = StructType.fromJson(record["schema"]).add(BUCKET, IntegerType())
        if not exists(self.spark, self.data):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.data)

    def _write_staged(self, rows: DataFrame, name: str) -> None:
        spreading = [f.name for f in rows.schema if isinstance(f.dataType, AtomicType)]
        part = F.pmod(F.xxhash64(*spreading), F.lit(FILES)) if spreading else F.lit(0)
        placed = rows.withColumn(BUCKET, self._bucket()).repartition(F.col(BUCKET), part)
        placed.write.partitionBy(BUCKET).parquet(f"{self.root}/{name}")

    def _settled(self) -> tuple[int, dict]:
        """The last record, after finishing what it had staged. Doing so twice gives the same folders."""
        number, record = self.log.latest()
        if record and record["buckets"] != self.buckets:
            raise ValueError(f"the table has {record['buckets']} buckets, not {self.buckets}")
        if "staged" not in record:
            return number, record
        staged = f"{self.root}/{record['staged']}"
        full = {int(n.split("=")[1]) for n in children(self.spark, staged) if n.startswith(f"{BUCKET}=")}
        if full:
            schema = StructType.fromJson(record["schema"]).add(BUCKET, IntegerType())
            writer = self.spark.read.schema(schema).parquet(staged).write.mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.data)
        for bucket in set(record["touched"]) - full:
            remove(self.spark, f"{self.data}/{BUCKET}={bucket}")
        record = {k: v for k, v in record.items() if k not in ("staged", "touched")}
        self.log.commit(number + 1, record)
        remove(self.spark, staged)
        return number + 1, record


def _typed(rows: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns and types, as far as the rows have them: equal keys of two types hash apart."""
    return rows.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema if f.name in rows.columns])
