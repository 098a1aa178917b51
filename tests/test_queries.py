"""Every registered query against its SQL counterpart, and the shape of its plan."""

import re

import pytest

from __spark_entry__ import entry
from __spark_entry__ import queries as registered
from tallyhouse.operators import asof
from tallyhouse.operators.ranking import nth_values
from tallyhouse.plans import gold
from tests.compare import DATA, connect, difference
from workload.oracles import ORACLES
from workload.queries import queries
from workload.tables import Tables

FOLDER = str(DATA / "sf0.001")
QUERIES = queries()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLES.keys() and QUERIES.keys() <= registered().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, con, name):
    problem, _ = difference(spark, con, QUERIES[name], ORACLES[name], FOLDER)
    assert problem is None


def test_entry(spark):
    assert entry(spark).count() == 5


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no table is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_pairs_all_rows(spark, no_broadcast, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize(
    "name", ["top_item_per_customer", "dedup_latest", "clean_events"]
)
def test_losers_are_dropped_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit.*Partial", plan(spark, name))


@pytest.mark.parametrize("name", ["cart_accepted", "cart_remaining", "cart_bill", "inventory_after", "rank", "ntile"])
def test_no_python_worker_takes_part(spark, name):
    assert not re.search("Python|Arrow|Pandas", plan(spark, name))


def test_lower_values_are_dropped_before_the_shuffle(spark):
    orders = Tables(spark, FOLDER).read("orders")
    nth = nth_values(orders, ["o_orderpriority"], "o_totalprice", 3)
    text = nth._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_a_day_is_in_the_merged_stream_once(spark):
    t = Tables(spark, FOLDER)
    sales, members = t.loyalty_sales(), t.members()
    stream = asof._merged(sales, members, "customer_id", "order_date", "join_date")
    days = sales.select("customer_id", "order_date").distinct().count()
    assert stream.count() == days + members.count() < sales.count() + members.count()


@pytest.mark.parametrize(
    "name", ["first_item_after", "last_item_before", "before_member_totals", "points_first_week"]
)
def test_few_members_are_broadcast(spark, no_broadcast, name):
    assert "BroadcastHashJoin [customer_id" in re.sub(r"#\d+L?", "", plan(spark, name))


@pytest.mark.parametrize(
    "name, pushed, columns",
    [
        ("orders_per_month", "GreaterThanOrEqual(o_orderdate", "struct<o_orderdate:timestamp_ntz>"),
        ("visit_days", "[]", "struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>"),
        ("incr_batch", "GreaterThan(ts", "struct<event_id:bigint,ts:timestamp_ntz,event_type:string>"),
        ("points_first_week", "LessThan(l_shipdate", "l_partkey:bigint,l_suppkey:bigint"),
    ],
)
def test_scans_read_what_they_need(spark, name, pushed, columns):
    df = QUERIES[name](spark, FOLDER)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    assert pushed in text and columns in text


def test_merging_state_and_delta_needs_no_further_shuffle(spark):
    assert plan(spark, "rollup_merge").count("Exchange hashpartitioning") == 2


def test_every_rollup_is_merged_with_its_state():
    merges = {"rollup_merge", *(f"rollup_merge_{name}" for name in gold.ROLLUPS if name != "channel_performance")}
    assert merges <= QUERIES.keys() and len(merges) == 5
