"""Placing documents on shards through a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.frames import digits

SHARDS = 32
TABLE_SIZE = 4099  # prime, about 128 slots a shard


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index of the shard that owns it.

    A shard prefers the slots offset, offset + skip, offset + 2 skip, ... modulo the prime size, a
    permutation of its own. The shards take turns; each claims the first slot of its list that is
    still free. Shares differ by one slot at most, and when a shard goes, few slots of the others move.
    """
    if not 0 < len(shards) <= size or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the size must be a prime, and there must be 1 to size shards")
    if len(set(shards)) < len(shards):
        raise ValueError("shard names must differ")
    at = [_number("offset:" + s) % size for s in shards]
    skip = [_number("skip:" + s) % (size - 1) + 1 if size > 2 else 1 for s in shards]
    owner = [-1] * size
    for turn in range(size):
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + skip[i]) % size
        owner[at[i]] = i
    return owner


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def table_frame(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """The table as rows (slot int, shard int)."""
    owners = ",".join(map(str, lookup_table(shards, size)))
    listed = F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "shard")
    return spark.range(1).select(listed).select("slot", F.col("shard").cast("int").alias("shard"))


def shard(
    docs: DataFrame,
    shards: list[str] | None = None,
    size: int = TABLE_SIZE,
    key: str = "doc_id",
    slot: str = "slot",
    into: str = "shard",
) -> DataFrame:
    """docs with two columns more: the slot of the key and the shard (an index into shards).

    The table has ``size`` rows whatever the data, so it is broadcast and no row is shuffled.
    Columns of docs named like slot or into are replaced. Rows with the same key go to the same
    shard; a null key counts as an empty one. Every other column is passed on as it is, nulls,
    empty and long texts included; an empty input gives an empty output.
    """
    names = shards or shard_names()
    kept = [c for c in docs.columns if c not in (slot, into)]
    table = table_frame(docs.sparkSession, names, size).select(
        F.col("slot").alias("__slot"), F.col("shard").alias("__shard")
    )
    hashed = (digits(F.col(f"`{key}`"), "place:") % size).cast("int")
    rows = docs.withColumn("__at", hashed)
    placed = rows.join(F.broadcast(table), F.col("__at") == F.col("__slot"))
    return placed.select(
        *[F.col(f"`{c}`") for c in kept], F.col("__at").alias(slot), F.col("__shard").alias(into)
    )
