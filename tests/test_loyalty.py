import datetime as dt

import pytest

from tallyhouse.plans import loyalty


def day(d, month=1):
    return dt.date(2021, month, d)


@pytest.fixture
def sales(table):
    return table(
        "customer_id string, order_date date, product_id int",
        [
            ("A", day(1), 1),
            ("A", day(7), 2),
            ("A", day(9), 2),
            ("B", day(1), 2),
            ("B", day(4), 1),
            ("B", day(16), 3),
            ("C", day(1), 3),
        ],
    )


@pytest.fixture
def menu(table):
    return table(
        "product_id int, product_name string, price int",
        [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)],
    )


@pytest.fixture
def members(table):
    return table(
        "customer_id string, join_date date", [("A", day(7)), ("B", day(9)), ("D", day(9))]
    )


def test_spend_and_visits(sales, menu, rows):
    assert rows(loyalty.spend_per_customer(sales, menu)) == [("A", 40), ("B", 37), ("C", 12)]
    assert rows(loyalty.visit_days(sales)) == [("A", 3), ("B", 3), ("C", 1)]


def test_same_day_counts_once(table, rows):
    sales = table(
        "customer_id string, order_date date, product_id int",
        [("A", day(1), 1), ("A", day(1), 2)],
    )
    assert rows(loyalty.visit_days(sales)) == [("A", 1)]


def test_first_item_by_separate_minima(sales, menu, rows):
    assert rows(loyalty.first_item_rowvalue(sales, menu)) == [("A", "sushi"), ("C", "ramen")]


def test_first_item_by_separate_minima_repeats_repeated_purchases(table, menu, rows):
    sales = table(
        "customer_id string, order_date date, product_id int",
        [("A", day(1), 1), ("A", day(1), 1), ("A", day(2), 2)],
    )
    assert rows(loyalty.first_item_rowvalue(sales, menu)) == [("A", "sushi"), ("A", "sushi")]


def test_first_item_true_gives_every_customer_one(sales, menu, rows):
    assert rows(loyalty.first_item_true(sales, menu)) == [
        ("A", "sushi"),
        ("B", "curry"),
        ("C", "ramen"),
    ]


def test_most_purchased_and_favourites(sales, menu, rows):
    assert rows(loyalty.most_purchased(sales, menu)) == [("curry", 3)]
    assert rows(loyalty.top_item_per_customer(sales, menu)) == [
        ("A", "curry", 2),
        ("B", "curry", 1),
        ("B", "ramen", 1),
        ("B", "sushi", 1),
        ("C", "ramen", 1),
    ]


# 0: members do not fit a broadcast, so the customer-day form runs.
both_sizes = pytest.mark.parametrize("size", [1_000_000, 0])


def test_first_after_and_last_before_joining(sales, menu, members, rows):
    assert rows(loyalty.first_item_after(sales, menu, members)) == [
        ("A", "curry", day(7)),
        ("B", "ramen", day(16)),
    ]
    assert rows(loyalty.last_item_before(sales, menu, members)) == [
        ("A", "sushi", day(1)),
        ("B", "sushi", day(4)),
    ]


def test_all_items_of_the_chosen_day_are_returned(table, menu, members, rows):
    sales = table(
        "customer_id string, order_date date, product_id int",
        [("A", day(8), 1), ("A", day(8), 2), ("A", day(9), 3), ("A", day(6), 3), ("A", day(6), 3)],
    )
    assert rows(loyalty.first_item_after(sales, menu, members)) == [
        ("A", "curry", day(8)),
        ("A", "sushi", day(8)),
    ]
    assert rows(loyalty.last_item_before(sales, menu, members)) == [
        ("A", "ramen", day(6)),
        ("A", "ramen", day(6)),
    ]


def test_unlisted_first_product_gives_no_row_not_the_next_one(table, menu, members, rows):
    sales = table(
        "customer_id string, order_date date, product_id int",
        [("A", day(7), 99), ("A", day(9), 1), ("A", day(5), 99), ("A", day(4), 1)],
    )
    assert rows(loyalty.first_item_after(sales, menu, members)) == []
    assert rows(loyalty.last_item_before(sales, menu, members)) == []


def test_two_memberships_are_anchored_separately(table, menu, rows):
    sales = table(
        "customer_id string, order_date date, product_id int",
        [("A", day(2), 1), ("A", day(8), 2)],
    )
    members = table(
        "customer_id string, join_date date", [("A", day(1)), ("A", day(5))]
    )
    assert rows(loyalty.first_item_after(sales, menu, members)) == [
        ("A", "curry", day(8)),
        ("A", "sushi", day(2)),
    ]


@both_sizes
def test_totals_before_joining(sales, menu, members, rows, size):
    assert rows(loyalty.before_member_totals(sales, menu, members, size)) == [
        ("A", 1, 10),
        ("B", 2, 25),
        ("D", 0, None),
    ]


@both_sizes
def test_totals_count_unlisted_products_without_amount(table, menu, members, rows, size):
    sales = table("customer_id string, order_date date, product_id int", [("A", day(1), 99)])
    found = rows(loyalty.before_member_totals(sales, menu, members, size))
    assert found[0] == ("A", 1, None)


@both_sizes
def test_points(sales, menu, members, rows, size):
    assert rows(loyalty.points_sushi(sales, menu)) == [("A", 500), ("B", 470), ("C", 120)]
    found = loyalty.points_first_week(
        sales, menu, members, until=day(31), broadcast_rows=size
    )
    assert rows(found) == [("A", 800), ("B", 470)]


@both_sizes
def test_points_week_includes_day_six_and_stops_at_the_end_date(table, menu, rows, size):
    sales = table(
        "customer_id string, order_date date, product_id int",
        [("A", day(13), 3), ("A", day(14), 3), ("A", day(1, 2), 3)],
    )
    members = table("customer_id string, join_date date", [("A", day(7))])
    found = loyalty.points_first_week(
        sales, menu, members, until=day(31), broadcast_rows=size
    )
    assert rows(found) == [("A", 12 * 20 + 12 * 10)]


def test_top_payers_break_ties_by_customer(table, menu, rows):
    sales = table(
        "customer_id string, order_date date, product_id int",
        [(c, day(1), 1) for c in "FEDCBA"],
    )
    assert [r[0] for r in rows(loyalty.top5_payers(sales, menu))] == list("ABCDE")


def test_answers_come_in_order(spark):
    """By customer, then by what tells the rows of one customer apart; many tasks take part."""
    days = [dt.date(2021, 1, d) for d in (1, 2, 3)]
    sales = spark.createDataFrame(
        [(f"c{c:02d}", days[(c + p) % 3], p) for c in range(40) for p in (1, 2, 3)],
        "customer_id string, order_date date, product_id int",
    ).repartition(7)
    menu = spark.createDataFrame([(1, "z", 5), (2, "a", 5), (3, "m", 5)], "product_id int, product_name string, price int")
    members = spark.createDataFrame([(f"c{c:02d}", days[c % 2]) for c in range(39, -1, -1)], "customer_id string, join_date date")
    for found in (
        loyalty.top_item_per_customer(sales, menu),
        loyalty.first_item_after(sales, menu, members).select("customer_id", "order_date", "FirstProduct"),
        loyalty.last_item_before(sales, menu, members).select("customer_id", "order_date", "ProductBeforeMem"),
        loyalty.before_member_totals(sales, menu, members),
        loyalty.points_sushi(sales, menu),
        loyalty.points_first_week(sales, menu, members, dt.date(2021, 12, 31)),
    ):
        rows = [tuple(r) for r in found.collect()]
        assert len(rows) > 10 and [r[:2] for r in rows] == sorted(r[:2] for r in rows)


@pytest.mark.parametrize("coalesce", ["true", "false"], ids=["one run", "many runs"])
def test_nearest_days_of_a_busy_key_over_many_runs(spark, coalesce):
    """Against a look at every event for every anchor; one key has most of the events."""
    import random

    from tallyhouse.operators import asof

    r = random.Random(4)
    start = dt.date(2020, 1, 1)
    days = lambda: start + dt.timedelta(days=r.randrange(900))
    events = [(r.choice(["hot", "hot", "hot", "b", None]), r.choice([days(), days(), days(), None]), i) for i in range(600)]
    anchors = [(r.choice(["hot", "b", "c", None]), r.choice([days(), start, dt.date(2023, 1, 1), None])) for _ in range(80)]
    event_df = spark.createDataFrame(events, "k string, d date, id int").repartition(5)
    anchor_df = spark.createDataFrame(anchors, "k string, a date")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        if coalesce == "false":
            runs = asof._merged(event_df, anchor_df, "k", "d", "a")
            assert runs.where("k = 'hot'").select("__run").distinct().count() > 1
        for search, fits, pick in ((asof.first_on_or_after, lambda d, a: d >= a, min), (asof.last_before, lambda d, a: d < a, max)):
            expected = set()
            for k, a in set(anchors):
                near = [d for key, d, _ in events if k is not None and key == k and a and d and fits(d, a)]
                expected |= {(k, d, i, a) for key, d, i in events if near and key == k and d == pick(near)}
            found = [tuple(x) for x in search(event_df, anchor_df, "k", "d", "a").select("k", "d", "id", "a").collect()]
            assert len(found) == len(set(found)) and set(found) == expected
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
