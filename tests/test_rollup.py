from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyhouse.operators.rollup import ROW_COUNT, Rollup
from tests.conftest import rows_of

ROLLUP = Rollup("r", ("k", "c"), {"total": "v", "n": ROW_COUNT})
SCHEMA = "k string, c string, v bigint"

_row = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.sampled_from(["ca", "us"]),
    st.one_of(st.none(), st.integers(-5, 5)),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(_row, max_size=12), cut=st.integers(0, 12))
def test_state_plus_delta_equals_the_total(spark, data, cut):
    whole = ROLLUP.delta(spark.createDataFrame(data, SCHEMA))
    state = ROLLUP.delta(spark.createDataFrame(data[:cut], SCHEMA))
    delta = ROLLUP.delta(spark.createDataFrame(data[cut:], SCHEMA))
    assert rows_of(ROLLUP.merge(state, delta)) == rows_of(whole)


def test_first_run_has_no_state(table, rows):
    delta = ROLLUP.delta(table(SCHEMA, [("a", "ca", 1), ("a", "ca", 2)]))
    assert rows(ROLLUP.merge(None, delta)) == [("a", "ca", 3, 2)]


def test_distinct_counts_do_not_depend_on_batches(spark):
    """Any order, any split and a batch merged twice give the estimate of all rows; a video counts once."""
    from functools import reduce

    from tallyhouse.operators.rollup import DistinctCount

    videos = spark.range(60_000).selectExpr("concat('v', id % 40000) as v", "if(id % 40000 < 30000, 'ca', 'us') as c", "id")
    count = DistinctCount("d", ("c",), "v")
    parts = [count.delta(videos.where(f"id % 3 = {i}")) for i in range(3)]
    whole = rows_of(count.estimate(count.delta(videos)))
    for order in ([0, 1, 2], [2, 0, 1], [1, 1, 0, 2, 2]):
        state = reduce(count.merge, [parts[i] for i in order], None)
        assert rows_of(count.estimate(state)) == whole
    for country, estimate in whole:
        exact = {"ca": 30_000, "us": 10_000}[country]
        assert abs(estimate - exact) <= 0.02 * exact
    few = spark.createDataFrame([("x", "ca"), ("x", "ca"), (None, "ca"), (None, "us")], "v string, c string")
    assert rows_of(count.estimate(count.delta(few))) == [("ca", 1), ("us", 0)]
