"""Tables whose files become visible by one commit record.

``BatchedTable`` grows by numbered batches. ``VersionedTables`` replaces a set of tables at once,
which is how a table is rewritten from its own contents: overwriting a folder that the running
plan still reads destroys it. Records also hold the schema, since a table without rows may have no
file to read it from.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyhouse.operators import membership
from tallyhouse.sources.storage import CommitLog, children, remove


def _run_id() -> str:
    return uuid.uuid4().hex[:12]


class BatchedTable:
    """Layout: ``<root>/batch=<n>-<run>/`` for data, ``<root>/_commits/`` for the records.

    Every write has a folder of its own, named by its record: two runs that prepare the same batch
    never touch each other's files, and the one that commits second fails with nothing replaced.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_commits")
        self._drafts: dict[int, str] = {}
        self._rejects: dict[int, dict] = {}
        self._members: dict[int, dict] = {}

    def state(self) -> tuple[int, dict]:
        """(last committed batch, its record)."""
        return self.log.latest()

    def write(self, batch: int, df: DataFrame) -> DataFrame:
        """Write the files of a batch, visible once committed, and read them back."""
        name = f"batch={batch}-{_run_id()}"
        df.write.parquet(f"{self.root}/{name}")
        self._drafts[batch] = name
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def commit(self, batch: int, written: DataFrame, **facts: object) -> None:
        """Make what ``write`` returned for this batch visible."""
        record = {**facts, "folder": self._drafts[batch], "schema": written.schema.jsonValue()}
        self.log.commit(batch, {**record, **self._beside(batch)})
        self._forget(batch)

    def write_rejects(self, batch: int, df: DataFrame) -> None:
        """Write the rows a batch leaves out; they become visible by the commit of the batch."""
        name = f"rejects={batch}-{_run_id()}"
        df.write.parquet(f"{self.root}/{name}")
        self._rejects[batch] = {"folder": name, "schema": df.schema.jsonValue()}

    def write_members(self, batch: int, written: DataFrame, key: str, rows: int) -> None:
        """Write a filter of the keys of a batch of so many rows; its commit record names it."""
        name, blocks = f"members={batch}-{_run_id()}", membership.blocks_for(rows)
        membership.filter_of(written, key, batch, blocks).write.parquet(f"{self.root}/{name}")
        self._members[batch] = {"folder": name, "key": key, "blocks": blocks}

    def _beside(self, batch: int) -> dict:
        written = {"rejects": self._rejects, "members": self._members}
        return {name: facts[batch] for name, facts in written.items() if batch in facts}

    def _forget(self, batch: int) -> None:
        for written in (self._drafts, self._rejects, self._members):
            written.pop(batch, None)

    def holding(self, rows: DataFrame, key: str) -> list[int]:
        """The committed batches that may hold a key of ``rows``, in order, found from their filters alone.

        No batch that does hold one is left out. A batch written without a filter of this key is always named.
        """
        last, _ = self.state()
        found, filtered = [], {}
        for number in range(1, last + 1):
            record = self.log.record(number)
            members = record.get("members", {})
            if members.get("key") == key:
                filtered.setdefault(members["blocks"], []).append(f"{self.root}/{members['folder']}")
            elif "folder" in record:
                found.append(number)
        for blocks, folders in filtered.items():
            filters = self.spark.read.schema(membership.SCHEMA).parquet(*folders)
            hits = membership.may_hold(filters, rows, key, blocks)
            found += [row.batch for row in hits.collect()]  # batch numbers, no keys
        return sorted(found)

    def rejects(self, first: int, last: int) -> DataFrame | None:
        """The rows that a range of committed batches left out, or None when none was kept."""
        kept = [r["rejects"] for r in map(self.log.record, range(first, last + 1)) if "rejects" in r]
        if not kept:
            return None
        return self.spark.read.schema(StructType.fromJson(kept[-1]["schema"])).parquet(
            *[f"{self.root}/{r['folder']}" for r in kept]
        )

    def pass_over(self, batch: int, **facts: object) -> None:
        """Commit a record without rows: the facts move on, nothing is written or read for it."""
        self.log.commit(batch, {**facts, **self._beside(batch)})
        self._forget(batch)

    def batches(self, first: int, last: int) -> DataFrame | None:
        """Rows of a range of committed batches; no other folder is listed or read. None without any."""
        return self.picked(range(first, last + 1))

    def picked(self, numbers: Iterable[int]) -> DataFrame | None:
        """Rows of the committed batches with these numbers; None without any."""
        records = [self.log.record(n) for n in numbers]
        records = [r for r in records if "folder" in r]
        if not records:
            return None
        return self.spark.read.schema(StructType.fromJson(records[-1]["schema"])).parquet(
            *[f"{self.root}/{r['folder']}" for r in records]
        )

    def read(self, after: int = 0) -> DataFrame | None:
        """Rows of the committed batches numbered above ``after``, or None when there are none."""
        last, _ = self.state()
        return self.batches(after + 1, last) if last > after else None


class Draft:
    """A new version in preparation. Nothing is visible before ``commit``."""

    def __init__(self, store: VersionedTables):
        self.store = store
        number, self.record = store.state()
        self.version = number + 1
        self.run = _run_id()
        self.written: dict[str, dict] = {}

    def write(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a table's new contents and return them as read back."""
        name = f"version={self.version}-{self.run}"
        path = self.store.path(table, name)
        df.write.partitionBy(*partition_by).parquet(path)
        self.written[table] = {
            "version": self.version,
            "folder": name,
            "schema": df.schema.jsonValue(),
        }
        return self.store.spark.read.schema(df.schema).parquet(path)

    def commit(self, **facts: object) -> int:
        tables = {**self.record.get("tables", {}), **self.written}
        self.store.log.commit(self.version, {**self.record, **facts, "tables": tables})
        return self.version


class VersionedTables:
    """Layout: ``<root>/<table>/version=<n>-<run>/`` for data, ``<root>/_commits/`` for the records."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_commits")

    def state(self) -> tuple[int, dict]:
        return self.log.latest()

    def path(self, table: str, folder: str) -> str:
        return f"{self.root}/{table}/{folder}"

    def read(self, table: str) -> DataFrame | None:
        """The committed version, or None before the first."""
        entry = self.state()[1].get("tables", {}).get(table)
        if entry is None:
            return None
        schema = StructType.fromJson(entry["schema"])
        return self.spark.read.schema(schema).parquet(self.path(table, entry["folder"]))

    def draft(self) -> Draft:
        return Draft(self)

    def overwrite(self, table: str, df: DataFrame, **facts: object) -> int:
        """Replace one table; ``df`` may be computed from its current contents."""
        draft = self.draft()
        draft.write(table, df)
        return draft.commit(**facts)

    def drop_older(self, keep: int = 2) -> list[str]:
        """Delete table versions that none of the last ``keep`` commits points at.

        Readers that started on an older commit must be done by then. Folders newer than the last
        commit belong to a running draft and stay.
        """
        last, _ = self.state()
        needed, dropped = set(), []
        tables: set[str] = set()
        for number in range(max(last - keep + 1, 1), last + 1):
            for table, entry in self.log.record(number).get("tables", {}).items():
                tables.add(table)
                needed.add((table, entry["folder"]))
        for table in sorted(tables):
            for name in sorted(children(self.spark, f"{self.root}/{table}")):
                version = int(name.removeprefix("version=").split("-")[0])
                if version <= last and (table, name) not in needed:
                    remove(self.spark, self.path(table, name))
                    dropped.append(f"{table}/{name}")
        return dropped
