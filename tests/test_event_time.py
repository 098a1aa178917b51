import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.rollup import ROW_COUNT, Rollup
from tallyhouse.streaming import event_time
from tests.conftest import rows_of

SCHEMA = "id string, at timestamp, kind string, views long"
BY_KIND = Rollup("by_kind", ("kind",), {"views": "views", "rows": ROW_COUNT})


class Feed:
    """Files in a landing folder, read one per step in the order they came in."""

    def __init__(self, spark, root):
        self.spark, self.root, self.files = spark, root, 0

    def land(self, rows):
        times = [(i, None if at is None else f"2024-01-{at}:00:00", kind, n) for i, at, kind, n in rows]
        df = self.spark.createDataFrame(times, "id string, at string, kind string, views long")
        df = df.withColumn("at", F.col("at").cast("timestamp"))
        df.coalesce(1).write.parquet(f"{self.root}/landing/step={self.files:03d}")
        self.files += 1
        return self

    def rows(self):
        return self.spark.read.schema(SCHEMA).parquet(f"{self.root}/landing/step=*")

    def drain(self):
        stream = (
            self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/landing/step=*")
        )
        query = event_time.stream_days(
            stream, "at", ["id"], BY_KIND, "1 day", f"{self.root}/days", f"{self.root}/checkpoint"
        )
        query.awaitTermination(120)
        assert query.exception() is None
        return query

    def days(self):
        days = self.spark.read.parquet(f"{self.root}/days")
        return rows_of(days.select(F.date_format("day", "dd"), "kind", "views", "rows"))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def test_out_of_order_files_equal_the_batch_rollup(feed):
    feed.land([("c", "02T09", "a", 4), ("b", "01T20", "a", 2), (None, "01T08", None, 8)])
    feed.land([("a", "01T10", "a", 1), ("d", "02T23", "b", 16)])
    feed.land([("e", "03T01", "a", 32)]).land([("f", "02T02", "b", 64), ("end", "09T00", "a", 0)])
    assert event_time.late_rows(feed.drain()) == 0
    closed = event_time.daily(feed.rows(), "at", BY_KIND).where("day < '2024-01-08'")
    assert feed.days() == rows_of(closed.select(F.date_format("day", "dd"), "kind", "views", "rows"))
    assert ("01", "a", 3, 2) in feed.days() and ("01", None, 8, 1) in feed.days()


def test_late_rows_are_counted_and_repeats_are_not_added(feed):
    feed.land([("a", "01T10", "a", 1), ("b", "01T11", "a", 2), ("a", "01T10", "a", 1)])
    feed.land([("b", "01T11", "a", 2), ("c", "04T00", "a", 4)])
    feed.land([("g", "01T13", "b", 16)])  # the step before had not yet closed the day
    feed.land([("x", "01T12", "a", 100), ("y", "02T12", "b", 100), ("d", "03T12", "a", 8), ("z", None, "a", 100)])
    feed.land([("end", "09T00", "a", 0)])
    assert event_time.late_rows(feed.drain()) == 2
    assert feed.days() == [("01", "a", 3, 2), ("01", "b", 16, 1), ("03", "a", 8, 1), ("04", "a", 4, 1)]


def test_a_restart_goes_on_from_the_checkpoint(feed):
    feed.land([("a", "01T10", "a", 1), ("b", "02T12", "a", 2)])
    feed.drain()
    feed.land([("c", "02T13", "a", 4), ("a", "01T10", "a", 1), ("d", "04T10", "a", 8)])
    feed.drain()
    first = feed.days()
    feed.drain()  # nothing new
    assert feed.days() == first == [("01", "a", 1, 1), ("02", "a", 6, 2)]
    feed.land([("e", "02T14", "a", 100), ("end", "09T00", "a", 0)])
    assert event_time.late_rows(feed.drain()) == 1
    assert feed.days() == [("01", "a", 1, 1), ("02", "a", 6, 2), ("04", "a", 8, 1)]


def test_a_count_of_late_rows_is_whole_or_refused(feed, spark):
    feed.land([("a", "01T10", "a", 1)]).land([("b", "01T11", "a", 1)])
    spark.conf.set(event_time.KEPT_REPORTS, "2")
    try:
        with pytest.raises(ValueError, match="numRecentProgressUpdates"):
            event_time.late_rows(feed.drain())
    finally:
        spark.conf.unset(event_time.KEPT_REPORTS)
