import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators import ranking
from tests.conftest import rows_of

EMP = "emp string, salary int"


@pytest.fixture
def emp(table):
    return table(EMP, [("A", 5000), ("B", 5000), ("C", 4000)])


def test_rank_and_dense_rank(emp, rows):
    ranked = ranking.with_rank(emp, "salary")
    dense = ranking.with_rank(emp, "salary", name="d", dense=True)
    assert rows(ranked.select("emp", "rank")) == [("A", 1), ("B", 1), ("C", 3)]
    assert rows(dense.select("emp", "d")) == [("A", 1), ("B", 1), ("C", 2)]


def test_third_row_is_not_the_third_value(emp, rows):
    third = ranking.top_rows(emp, "salary", ["emp"], 1, skip=2)
    assert rows(third) == [("C", 4000)]
    grouped = emp.withColumn("dept", F.lit("d"))
    assert rows(ranking.nth_value_rows(grouped, ["dept"], "salary", 3)) == []
    assert rows(ranking.nth_value_rows(grouped, ["dept"], "salary", 1).select("emp")) == [
        ("A",),
        ("B",),
    ]


def test_above_mean_compares_inside_the_group(table, rows):
    df = table(
        "dept string, salary int", [("x", 1), ("x", 3), ("y", 10), ("y", 10), (None, 99), (None, 1)]
    )
    assert rows(ranking.above_group_mean(df, ["dept"], "salary")) == [("x", 3)]


def test_group_value_keeps_every_row(table, rows):
    df = table("dept string, salary int", [("x", 1), ("x", 3), (None, 5), (None, 6)])
    assert rows(ranking.with_group_value(df, ["dept"], F.sum("salary"), "t")) == [
        ("x", 1, 4),
        ("x", 3, 4),
        (None, 5, 11),
        (None, 6, 11),
    ]
    total = ranking.with_group_value(df, [], F.sum("salary"), "t")
    assert {r.t for r in total.collect()} == {15}


def test_leaders_keep_ties(table, rows):
    df = table("k string, v int", [("a", 1), ("a", 2), ("a", 2), ("b", 0)])
    assert rows(ranking.leaders(df, ["k"], "v")) == [("a", 2), ("a", 2), ("b", 0)]


def _plain(df, keys, order, descending, tiles):
    """What Spark's own windows answer."""
    by = Window.partitionBy(*keys)
    value = by.orderBy(F.col("v").desc() if descending else F.col("v").asc())
    rows = by.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in order])
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return [
        df.withColumn("p", c)
        for c in (
            F.rank().over(value), F.dense_rank().over(value), F.row_number().over(rows),
            F.ntile(tiles).over(rows), F.sum("w").over(upto),
        )
    ]


def _ours(df, keys, order, descending, tiles):
    return [
        ranking.with_rank(df, "v", keys, "p", descending),
        ranking.with_rank(df, "v", keys, "p", descending, dense=True),
        ranking.with_row_number(df, order, keys, "p"),
        ranking.with_ntile(df, tiles, order, keys, "p"),
        ranking.with_running_total(df, "w", order, keys, "p"),
    ]


@pytest.fixture(params=["one run", "many runs"])
def runs(spark, request):
    """Adaptive execution makes one run of a small table; without it there are as many as partitions."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(request.param == "one run").lower())
    yield request.param
    spark.conf.set(setting, before)


@pytest.mark.parametrize("keys", [["k"], []], ids=["grouped", "whole table"])
@pytest.mark.parametrize("seed, descending, tiles", [(1, True, 4), (2, False, 7)])
def test_equal_to_the_plain_windows(spark, runs, seed, descending, tiles, keys):
    rng = random.Random(seed)
    groups, values = ["hot"] * 6 + ["x", None], [*range(-3, 4), None]
    data = [(i, rng.choice(groups), rng.choice(values)) for i in range(200)]
    df = spark.createDataFrame(data, "id int, k string, v int")
    df = df.withColumn("w", F.when(F.col("id") % 9 > 0, F.col("id") % 5)).repartition(3)
    order = [("v", descending), ("id", not descending)]
    args = (df, keys, order, descending, tiles)
    for ours, plain in zip(_ours(*args), _plain(*args), strict=True):
        assert rows_of(ours.select("id", "p")) == rows_of(plain.select("id", "p"))


@pytest.mark.parametrize(
    "kind, values",
    [
        ("date", [dt.date(2024, 1, 1 + i % 9) for i in range(30)]),
        ("timestamp_ntz", [dt.datetime(2024, 1, 1, i % 9, 0, 0, i) for i in range(30)]),
        ("double", [float("nan"), float("inf"), -0.5, None] + [i / 4 for i in range(26)]),
        ("string", [None, "", "a", "a\x00", "abcdefg", "abcdefh", "é", "z", "\U0001f600", "a"]),
        ("binary", [None, b"", b"\x00", b"\xff", b"abcdefgh", b"abcdefgi"]),
        ("boolean", [True, False, None, True]),
        ("array<int>", [[1], [1, 2], None, [0]]),
        ("struct<a:int,b:string>", [(1, "x"), (1, None), None, (0, "z"), (None, "z")]),
    ],
)
def test_any_orderable_type(spark, kind, values):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(list(enumerate(values)), f"id int, v {kind}").withColumn("w", F.lit(1))
        args = (df, [], [("v", False), ("id", False)], False, 3)
        for ours, plain in zip(_ours(*args), _plain(*args), strict=True):
            assert rows_of(ours.select("id", "p")) == rows_of(plain.select("id", "p"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("prefix", ["", "https://site/"])
def test_one_group_is_spread_over_all_runs(spark, prefix):
    """No run holds much more than its share of a single hot group, whatever its values begin with."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select(
            F.lit("hot").alias("k"), F.concat(F.lit(prefix), F.lpad(F.col("id").cast("string"), 9, "0")).alias("v")
        )
        dealt = ranking.in_runs(df, [("v", False)], ["k"])
        sizes = [r["count"] for r in dealt.groupBy("__run").count().collect()]
        assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert max(sizes) < 2 * 20_000 / len(sizes)
        numbered = ranking.with_row_number(df, [("v", False)], ["k"])
        assert numbered.where(F.substring("v", -9, 9).cast("long") + 1 != F.col("row_number")).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_rows_and_a_name_that_is_taken(spark):
    df = spark.createDataFrame([(1, 5, "old")], "id int, v int, rank string")
    assert ranking.with_rank(df, "v").collect()[0].rank == 1
    for out in _ours(df.limit(0).withColumn("w", F.lit(1)), [], [("id", False)], True, 2):
        assert out.count() == 0
