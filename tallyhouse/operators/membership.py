"""Which of many stored sets of keys may hold a key, without reading the sets.

A set is kept as a Bloom filter in blocks: one row per block, eight words of 64 bits each. A key belongs to one
block and sets one bit in each of its words, so a look-up is an equi-join on the block. A key that is in a set is
always found there; another one seldom (fewer than one key in 10,000 at ``KEYS_PER_BLOCK`` keys a block).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
KEYS_PER_BLOCK = 16
SCHEMA = ", ".join(["batch long", "block long", *[f"word_{i} long" for i in range(WORDS)]])


def blocks_for(keys: int) -> int:
    """A power of two, so that sets of like size have blocks of the same numbers and share one look-up."""
    return 1 << max((keys - 1) // KEYS_PER_BLOCK, 0).bit_length()


def _words() -> list[str]:
    return [f"word_{i}" for i in range(WORDS)]


def _bits(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, words) with the bits of each key; NULL is no key. Keys are compared as text."""
    text = F.col(key).cast("string")
    hashed = keys.where(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(text), F.lit(blocks)).alias("block"), F.xxhash64(text, F.lit(1)).alias("__h")
    )
    places = [f"shiftleft(1L, int(shiftright(__h, {6 * i}) & 63)) AS word_{i}" for i in range(WORDS)]
    return hashed.selectExpr("block", *places)


def filter_of(rows: DataFrame, key: str, batch: int, blocks: int) -> DataFrame:
    """The filter of a batch: at most ``blocks`` rows, added up before the shuffle."""
    words = [F.bit_or(w).alias(w) for w in _words()]
    filled = _bits(rows, key, blocks).groupBy("block").agg(*words)
    return filled.select(F.lit(batch).cast("long").alias("batch"), "block", *_words())


def _holds(word: str) -> Column:
    asked = F.col(f"asked.{word}")
    return F.col(f"stored.{word}").bitwiseAND(asked) == asked


def matches(filters: DataFrame, rows: DataFrame, key: str, blocks: int) -> DataFrame:
    """(batch), once for each different key of ``rows`` and each filter, all of so many blocks, that may hold it."""
    asked = _bits(rows, key, blocks).distinct().alias("asked")
    found = filters.alias("stored").join(asked, F.col("stored.block") == F.col("asked.block"))
    return found.where(reduce(Column.__and__, map(_holds, _words()))).select("stored.batch")


def may_hold(filters: DataFrame, rows: DataFrame, key: str, blocks: int) -> DataFrame:
    """(batch) for the filters that may hold any key of ``rows``."""
    return matches(filters, rows, key, blocks).distinct()
