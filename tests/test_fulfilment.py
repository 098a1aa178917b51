import random

import pytest

from tallyhouse.operators import fulfilment as f

LINES = "cart_id int, seq int, item_id int, qty int"


@pytest.fixture
def items(table):
    return table(
        "item_id int, name string, price int, stock int",
        [(1, "Apple", 20, 10), (2, "Milk", 60, 5), (3, "Bread", 40, 8)],
    )


def test_only_filled_lines_use_stock(table, items, rows):
    lines = table(LINES, [(1, 1, 2, 3), (2, 2, 2, 4), (3, 3, 2, 2)])
    filled = f.fill_lines(lines, items, ["seq"])
    assert [r[0] for r in rows(filled)] == [1, 3]
    assert rows(f.remaining_stock(items, filled)) == [(1, 10), (2, 0), (3, 8)]
    assert rows(f.inventory_after(items, filled).select("item_id", "price", "stock")) == [
        (1, 20, 10),
        (2, 60, 0),
        (3, 40, 8),
    ]


def test_rejects(table, items, rows):
    lines = table(LINES, [(1, 1, 9, 1), (1, 2, 1, 0), (1, 3, 1, -2), (1, 4, 1, 1), (1, 5, None, 1)])
    found = f.rejected_lines(lines, items)
    assert sorted((r.seq, r.reason) for r in found.collect()) == [
        (1, "unknown item"),
        (2, "quantity not positive"),
        (3, "quantity not positive"),
        (5, "unknown item"),
    ]
    assert [r[1] for r in rows(f.fill_lines(lines, items, ["seq"]))] == [4]


def test_delivery_tiers(table, rows):
    carts = table(
        "cart_id int, distance_km int", [(1, 15), (2, 16), (3, 30), (4, 31)]
    )
    assert [r[2] for r in rows(f.delivery(carts))] == [50, 100, 100, 0]


def test_bill(table, items, rows):
    lines = table(LINES, [(1, 1, 1, 2), (1, 2, 3, 1), (2, 3, 2, 6)])
    carts = table("cart_id int, distance_km int", [(1, 10), (2, 10)])
    filled = f.fill_lines(lines, items, ["seq"])
    # Cart 2 asked for more than there is, so it has no line and no bill.
    assert rows(f.bills(filled, items, carts)) == [(1, 80, 50, 130)]


# 10**6: every item is folded; 50: the busy one goes through rounds first; 0: rounds to the end.
@pytest.mark.parametrize("few, seed", [(10**6, 0), (50, 0), (50, 1), (0, 1)])
def test_equals_one_line_at_a_time(spark, rows, few, seed):
    rng = random.Random(seed)
    stock = {i: rng.choice([0, 3, 17, 60, 1500]) for i in range(5)}
    # Item 0 gets most of the lines.
    lines = [
        (rng.randint(1, 40), seq, rng.choice([0, 0, 0, 0, 1, 2, 3, 4, 5]), rng.randint(-1, 300))
        for seq in rng.sample(range(1000), 400)
    ]
    left, expected = dict(stock), []
    for line in sorted(lines, key=lambda r: r[1]):
        _, _, item, qty = line
        if item in left and 0 < qty <= left[item]:
            left[item] -= qty
            expected.append(line)

    lines_df = spark.createDataFrame(lines, LINES)
    items_df = spark.createDataFrame(
        [(i, f"i{i}", 1, s) for i, s in stock.items()],
        "item_id int, name string, price int, stock int",
    )
    filled = f.fill_lines(lines_df, items_df, ["seq"], few)
    assert rows(filled) == sorted(expected, key=repr)
    assert dict(rows(f.remaining_stock(items_df, filled))) == left


def test_large_and_missing_cart_ids_pass_unchanged(spark, rows):
    lines = [(2**53 + 1, 1, 1, 5), (None, 2, 1, 5), (7, 3, 1, 5)]
    items = spark.createDataFrame([(1, "x", 1, 10)], "item_id int, name string, price int, stock int")
    schema = "cart_id bigint, seq int, item_id int, qty int"
    filled = f.fill_lines(spark.createDataFrame(lines, schema), items, ["seq"])
    assert rows(filled) == rows(spark.createDataFrame(lines[:2], schema))


def test_a_busy_item_ends_without_a_long_fold(spark, rows, monkeypatch):
    """Two large lines, then thousands of ones: the rounds leave at most ``few`` lines to any fold."""
    folded = []
    fold = f._one_by_one

    def watched(open_lines, sequence):
        folded.append(open_lines.groupBy("item_id").count().agg({"count": "max"}).first()[0] or 0)
        return fold(open_lines, sequence)

    monkeypatch.setattr(f, "_one_by_one", watched)
    asked = [3600, 3601] + [1] * 6000
    lines = spark.createDataFrame([(i, i, 1, q) for i, q in enumerate(asked)], LINES)
    items = spark.createDataFrame([(1, "x", 1, 6000)], "item_id int, name string, price int, stock int")
    filled = f.fill_lines(lines, items, ["seq"], few=100)
    assert sorted(r.seq for r in filled.collect()) == [0, *range(2, 2402)]
    assert max(folded) <= 100
    assert "Python" not in filled._jdf.queryExecution().toString() and "Arrow" not in filled._jdf.queryExecution().toString()
