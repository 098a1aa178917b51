import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from tallyhouse.streaming import batches, catchup


def at(minute, day=1):
    return dt.datetime(2024, 1, day, 10, minute)


@pytest.fixture(params=["timestamp", "timestamp_ntz"])
def feed(request, table):
    rows = [(1, at(1)), (2, at(2)), (3, at(2)), (4, at(2)), (5, at(3, day=2)), (6, None)]
    return table(f"id int, ts {request.param}", rows)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_exact_batch_loses_ties_across_the_border(feed):
    first = batches.next_batch(feed, "ts", ["id"], None, 2)
    assert ids(first) == [1, 2]
    assert ids(batches.next_batch(feed, "ts", ["id"], at(2), 2)) == [5]


def test_whole_batch_takes_all_ties(feed):
    assert ids(batches.next_batch_whole(feed, "ts", None, 2)) == [1, 2, 3, 4]
    assert ids(batches.next_batch_whole(feed, "ts", at(2), 2)) == [5]


def test_batch_larger_than_the_rest(feed):
    assert ids(batches.next_batch(feed, "ts", ["id"], None, 100)) == [1, 2, 3, 4, 5]
    assert ids(batches.next_batch_whole(feed, "ts", None, 100)) == [1, 2, 3, 4, 5]


def test_nothing_new(feed):
    assert ids(batches.next_batch(feed, "ts", ["id"], at(3, day=2), 2)) == []
    assert ids(batches.next_batch_whole(feed, "ts", at(3, day=2), 2)) == []


def test_rows_without_time_are_set_aside(feed):
    assert ids(batches.without_timestamp(feed, "ts")) == [6]


def test_late_rows_are_not_read_again(feed):
    late = feed.where(batches.late_rows(feed, "ts", at(2)))
    assert ids(late) == [1, 2, 3, 4]
    assert ids(feed.where(batches.late_rows(feed, "ts", None))) == []


def test_batches_cover_everything_once(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3, i % 5)) for i in range(60)]
    feed = spark.createDataFrame(rows, "id int, ts timestamp")
    seen, mark = [], None
    while True:
        batch = batches.next_batch_whole(feed, "ts", mark, 7).collect()
        if not batch:
            break
        seen += [r.id for r in batch]
        mark = max(r.ts for r in batch)
    assert sorted(seen) == list(range(60))


def test_mark_in_microseconds(spark):
    feed = spark.createDataFrame([(1, at(1)), (2, at(2))], "id int, ts timestamp")
    micros = feed.selectExpr("unix_micros(min(ts))").first()[0]
    assert ids(batches.newer_than(feed, "ts", micros)) == [2]


def planned(times, n):
    """(rows, upto) of each batch, one row after the other."""
    out, inside, seen = [], 0, 0
    times = sorted(times)
    due = False
    for i, t in enumerate(times):
        inside, seen = inside + 1, seen + 1
        due = due or seen % n == 0
        if i + 1 == len(times) or (due and times[i + 1] != t):
            out.append((inside, t))
            inside, due = 0, False
    return out


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("n, spread, most_ranges", [(1, 5, 100), (7, 86400 * 3, 100), (7, 40, 0), (40, 7200, 2), (10**6, 9, 100)])
def test_plan_equals_a_running_count(table, monkeypatch, kind, n, spread, most_ranges):
    monkeypatch.setattr(catchup, "MOST_RANGES", most_ranges)
    r = random.Random(n)
    start = dt.datetime(2024, 1, 1, 23, 59, 50)
    times = [start + dt.timedelta(seconds=r.randrange(spread), microseconds=r.choice([0, 0, 1, 999_999])) for _ in range(150)]
    mark = sorted(times)[20]
    df = table(f"ts {kind}", [(t,) for t in times] + [(None,)] * 3)
    found = catchup.plan_batches(df, "ts", mark, n).collect()
    fresh = [t for t in times if t > mark]
    assert [(p.rows, p.upto) for p in found] == planned(fresh, n)
    assert [p.after for p in found] == [None, *[p.upto for p in found[:-1]]][: len(found)]
    assert [p.batch for p in found] == list(range(1, len(found) + 1))
    for p in found[:3]:
        rows = batches.between(df, "ts", p.after or mark, p.upto)
        assert rows.count() == p.rows


def test_plan_of_nothing(table):
    df = table("ts timestamp", [(dt.datetime(2024, 1, 1),), (None,)])
    assert catchup.plan_batches(df, "ts", dt.datetime(2024, 1, 1), 5).count() == 0


def test_the_plan_reads_twice_and_a_batch_its_own_files(spark, tmp_path):
    """One file an hour: rows read are counted where Spark reads them."""
    path = str(tmp_path / "events")
    hours = spark.range(0, 100 * 60).select(
        (F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 60_000_000)).alias("ts"), "id"
    )
    hours.repartitionByRange(100, "ts").write.parquet(path)
    source = spark.read.parquet(path)
    plan = catchup.plan_batches(source, "ts", None, 60).collect()
    assert len(plan) == 100 and {p.rows for p in plan} == {60}
    batch = batches.between(source, "ts", plan[40].after, plan[40].upto)
    pushed = batch._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in pushed and "LessThanOrEqual(ts," in pushed
    assert batch.count() == 60
