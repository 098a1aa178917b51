import datetime as dt
from decimal import Decimal

import pytest

from tallyhouse.plans import revenue


@pytest.fixture
def orders(table):
    return table(
        "order_id int, order_customer_id int, sum double, order_date date, order_status string",
        [
            (1, 10, 50.0, dt.date(2024, 1, 1), "closed"),
            (2, 10, 0.1, dt.date(2024, 2, 1), "open"),
            (3, 20, 50.1, dt.date(2024, 2, 10), "closed"),
            (4, 30, 7.0, dt.date(2024, 2, 12), "open"),
        ],
    )


def test_rank_keeps_gaps_after_ties(orders, rows):
    assert rows(revenue.customer_revenue_rank(orders)) == [
        (10, Decimal("50.10"), 1),
        (20, Decimal("50.10"), 1),
        (30, Decimal("7.00"), 3),
    ]


def test_pivot_loses_no_status(orders, rows, table):
    more = table(orders.schema, [(5, 30, 2.0, dt.date(2024, 3, 1), None)])
    found = revenue.status_pivot(orders.unionByName(more), ["closed", "lost"])
    assert found.columns == ["order_customer_id", "closed", "lost", "other"]
    assert rows(found) == [
        (10, Decimal("50.00"), None, Decimal("0.10")),
        (20, Decimal("50.10"), None, None),
        (30, None, None, Decimal("9.00")),
    ]


def test_pivot_looks_statuses_up(orders, rows):
    found = revenue.status_pivot(orders)
    assert found.columns == ["order_customer_id", "closed", "open", "other"]
    assert rows(found)[0] == (10, Decimal("50.00"), Decimal("0.10"), None)
    with pytest.raises(ValueError, match="other"):
        revenue.status_pivot(orders, ["other"])


def test_monthly_revenue(orders, rows):
    assert rows(revenue.monthly_revenue(orders)) == [
        ("2024-01", Decimal("50.00")),
        ("2024-02", Decimal("57.20")),
    ]


def test_churn_is_strict_and_relative_to_the_newest_order(orders, rows):
    assert rows(revenue.churned(orders, 10)) == [(10, dt.date(2024, 2, 1), 11)]
    assert rows(revenue.churned(orders, 11)) == []


def test_no_sum_stops_or_rounds_the_questions(spark, rows):
    from tallyhouse.operators import cleaning
    from tallyhouse.sources.schemas import RAW_ORDERS

    amounts = ["1e30", "NaN", "Infinity", "1e15", "0.005", "5", "999999999999999.5"]
    raw = spark.createDataFrame([(str(i), "25-07-2013", "11", "CLOSED", a) for i, a in enumerate(amounts, 1)], RAW_ORDERS)
    orders = cleaning.clean_orders(raw)
    assert sorted(r["sum"] for r in orders.collect()) == [0.005, 5.0, 999999999999999.5]
    assert rows(cleaning.audit_orders(raw))[2:] == [(3, "complete", 7), (4, "valid", 3)]
    small = orders.where("sum < 10")
    assert float(revenue.monthly_revenue(small).first().monthly_revenue) == 5.005
    assert float(revenue.customer_revenue_rank(small).first().total_revenue) == 5.005
    assert float(revenue.status_pivot(small, ["closed"]).first().closed) == 5.005
    assert revenue.monthly_revenue(orders).count() == 1


def test_a_key_is_no_pivot_heading(spark, monkeypatch):
    from tallyhouse.operators import grouping

    monkeypatch.setattr(grouping, "MOST_PIVOT_VALUES", 3)
    df = spark.createDataFrame([(1, f"v{i}", 1) for i in range(4)], "k int, p string, m int")
    with pytest.raises(ValueError, match="more than 3 values"):
        grouping.pivot_total(df, "k", "p", "m")
    assert grouping.pivot_total(df.where("p != 'v0'"), "k", "p", "m").columns == ["k", "v1", "v2", "v3", "other"]
