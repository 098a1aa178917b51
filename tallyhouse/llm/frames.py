"""Small pieces shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tallyhouse


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark context, as --py-files would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    top = Path(tallyhouse.__file__).parent
    target = Path(tempfile.mkdtemp()) / "tallyhouse-src.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(top.rglob("*.py")):
            out.write(source, source.relative_to(top.parent))
    context.addPyFile(str(target))


def crc_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key written as text, modulo modulus; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Rows kept out of training: one remainder, and rows without a key."""
    return F.coalesce(crc_remainder(key, modulus) == remainder, F.lit(True))


def digits(key: Column, salt: str) -> Column:
    """A long in [0, 2**60) from the md5 of salt and key; a null key counts as an empty one."""
    text = F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


#: Rows in an Arrow batch at most: whole texts are long, and two tasks of an executor hold several batches.
BATCH_ROWS = 1_000


def prepare(spark: SparkSession) -> None:
    """What a session needs before it runs these operators: the package, and batches of bounded size."""
    ship_package(spark)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def in_arrow(df: DataFrame, work: Callable[[pa.RecordBatch], pa.Table | None], schema) -> DataFrame:
    """mapInArrow with a function from one batch to one table (or None)."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = work(batch) if batch.num_rows else None
            if out is not None:
                yield from out.to_batches()

    return df.mapInArrow(over, schema)
