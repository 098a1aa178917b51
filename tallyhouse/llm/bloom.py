"""A Bloom filter of fixed size, to keep rows that can't match out of a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.frames import in_arrow

BITS = 23  # 2**23 bits are 1 MB, whatever the data; when it fills up it only lets more rows pass


def _places(keys: np.ndarray) -> np.ndarray:
    return (tx.mixed(keys.view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def build(keys: DataFrame) -> np.ndarray:
    """The filter of the longs in the only column of keys; nulls are always let through."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        values = batch.column(0).drop_null().to_numpy().astype(np.int64)
        at = np.unique(_places(values))
        return pa.table({"word": (at >> 6).astype(np.int32), "mask": (np.int64(1) << (at & 63)).astype(np.int64)})

    masks = in_arrow(keys, work, "word int, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    found = masks.toArrow()
    words = np.zeros(1 << (BITS - 6), np.int64)
    words[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return words


def narrowed(df: DataFrame, key: str, words: np.ndarray) -> DataFrame:
    """The rows of df whose key may be in the filter."""
    shared = df.sparkSession.sparkContext.broadcast(words)

    def work(batch: pa.RecordBatch) -> pa.Table:
        column = batch.column(key)
        at = _places(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        there = (shared.value[at >> 6] >> (at & 63)) & 1
        keep = (there == 1) | column.is_null().to_numpy(zero_copy_only=False)
        return pa.Table.from_batches([batch.filter(pa.array(keep))])

    return in_arrow(df, work, df.schema)
