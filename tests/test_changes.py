import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators import changes
from tests.conftest import rows_of

SCHEMA = "customer_id bigint, customer_name string, phone string"


@pytest.fixture
def master(table):
    return table(
        SCHEMA,
        [
            (101, "Ada", "111-111"),
            (102, "Bo", "222-222"),
            (103, "Cleo", "333-333"),
            (104, "Dan", "444-444"),
        ],
    )


@pytest.fixture
def updates(table):
    return table(
        SCHEMA, [(101, "Ada B", "111-999"), (103, "Cleo", None), (105, "Eva", "555-555")]
    )


def test_merge_takes_nulls_of_matched_rows(master, updates, rows):
    assert rows(changes.merge_upsert(master, updates, ["customer_id"])) == [
        (101, "Ada B", "111-999"),
        (102, "Bo", "222-222"),
        (103, "Cleo", None),
        (104, "Dan", "444-444"),
        (105, "Eva", "555-555"),
    ]


def test_merge_keeps_columns_the_source_does_not_carry(master, updates, rows):
    found = changes.merge_upsert(master, updates.drop("phone"), ["customer_id"])
    assert rows(found)[0] == (101, "Ada B", "111-111")
    assert rows(found)[-1] == (105, "Eva", None)


def test_delete_missing(master, updates, rows):
    found = changes.delete_missing(master, updates, ["customer_id"])
    assert [r[0] for r in rows(found)] == [101, 103]


def test_update_by_key(master, updates, rows):
    found = changes.update_by_key(master, updates, ["customer_id"], ["phone"])
    assert rows(found) == [
        (101, "Ada", "111-999"),
        (102, "Bo", "222-222"),
        (103, "Cleo", None),
        (104, "Dan", "444-444"),
    ]


def test_delete_where_keeps_unknown(updates, rows):
    found = changes.delete_where(updates, F.col("phone") == "111-999")
    assert [r[0] for r in rows(found)] == [103, 105]
    assert rows(changes.truncate(updates)) == []


_rows = st.dictionaries(
    st.integers(0, 8), st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from(["1", None])), max_size=8
).map(lambda d: [(k, *v) for k, v in d.items()])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=_rows, new=_rows)
def test_full_sync_equals_the_source(spark, old, new):
    target, source = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    assert rows_of(changes.full_sync(target, source, ["customer_id"])) == sorted(new, key=repr)


def test_merge_keeps_the_order_of_the_columns(master, updates):
    target = master.select("phone", "customer_id", "customer_name")
    assert changes.merge_upsert(target, updates, ["customer_id"]).columns == target.columns


def test_merge_stops_at_repeated_source_keys(master, updates, table):
    twice = updates.unionByName(updates.limit(1))
    for change in (changes.merge_upsert, changes.full_sync):
        with pytest.raises(Exception, match="several source rows for one value of customer_id"):
            change(master, twice, ["customer_id"]).collect()
    nameless = table(SCHEMA, [(None, "x", "1"), (None, "y", "2")])
    assert changes.merge_upsert(master, nameless, ["customer_id"]).count() == 6


def test_rows_without_a_key_take_no_part_in_the_join(spark, rows):
    """They pass, target and source, in as many tasks as they come in."""
    target = spark.createDataFrame([(1, "a", 1), (None, "t", 2)], "id int, name string, n int")
    source = spark.createDataFrame([(1, "b"), (None, "x"), (None, "x"), (2, "c")], "id int, name string")
    assert rows(changes.merge_upsert(target, source, ["id"])) == sorted(
        [(1, "b", 1), (2, "c", None), (None, "t", 2), (None, "x", None), (None, "x", None)], key=repr
    )
    many = spark.range(0, 3000, 1, 3).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("id"), F.lit("s").alias("name"))
    merged = changes.merge_upsert(target, many, ["id"]).withColumn("task", F.spark_partition_id())
    assert merged.where("id is null and name = 's'").select("task").distinct().count() == 3
