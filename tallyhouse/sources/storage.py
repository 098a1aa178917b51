"""Small-file calls on Spark's own file system layer, for existence checks and commit records."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_fs(spark, path).exists(_path(spark, path)))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder; none when it does not exist."""
    fs, folder = _fs(spark, path), _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class CommitLog:
    """Numbered JSON records in a folder; the highest number is the current state.

    A record is written under a name of its own and renamed without overwrite, so a number can be
    committed once. Data is written before its record: a run that dies in between leaves files no
    record points at. The folder has to be on a file system whose rename is atomic.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def latest(self) -> tuple[int, dict]:
        """(number, record); (0, {}) before the first commit."""
        names = children(self.spark, self.folder)
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        return (max(numbers), self.record(max(numbers))) if numbers else (0, {})

    def record(self, number: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.folder}/{number:09d}.json"))

    def commit(self, number: int, record: dict) -> None:
        """Publish a record; fails when the number is taken."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        draft = _path(self.spark, f"{self.folder}/.{number:09d}.{uuid.uuid4().hex}.draft")
        final = _path(self.spark, f"{self.folder}/{number:09d}.json")
        out = _fs(self.spark, self.folder).create(draft, True)
        try:
            out.write(bytearray(json.dumps(record).encode("utf-8")))
        finally:
            out.close()
        context = hadoop.FileContext.getFileContext(
            draft.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        rename = getattr(hadoop, "Options$Rename")
        no_overwrite = self.spark.sparkContext._gateway.new_array(rename, 0)
        context.rename(draft, final, no_overwrite)
