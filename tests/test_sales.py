import datetime as dt
from decimal import Decimal

import pytest

from tallyhouse.plans import sales


@pytest.fixture
def details(table):
    return table(
        "orderNumber int, productCode string, quantityOrdered int, priceEach decimal(10,2)",
        [
            (1, "p1", 2, Decimal("10.00")),
            (1, "p2", 1, Decimal("5.50")),
            (2, "p1", 3, Decimal("10.00")),
            (3, "p3", 1, Decimal("100.00")),
        ],
    )


@pytest.fixture
def products(table):
    return table(
        "productCode string, productName string, productLine string",
        [("p1", "car", "cars"), ("p2", "bus", "cars"), ("p3", "ship", "ships"), ("p4", "x", "cars")],
    )


@pytest.fixture
def employees(table):
    return table(
        "employeeNumber int, firstName string, lastName string",
        [(7, "Ann", "Lee"), (8, "Bob", None), (9, "Cy", "Poe")],
    )


@pytest.fixture
def customers(table):
    return table(
        "customerNumber int, salesRepEmployeeNumber int", [(1, 7), (2, 7), (3, 8), (4, None)]
    )


def test_top_reps(employees, customers, table, details, rows):
    orders = table("orderNumber int, customerNumber int", [(1, 1), (2, 3), (3, 4)])
    found = sales.top_reps(employees, customers, orders, details)
    assert rows(found) == [
        (7, "Ann", "Lee", Decimal("25.50")),
        (8, "Bob", None, Decimal("30.00")),
    ]


def test_product_questions(products, details, table, rows):
    lines = table("productLine string", [("cars",), ("ships",), ("planes",)])
    assert rows(sales.top_product_line(lines, products, details)) == [("ships", Decimal("100.00"))]
    assert rows(sales.never_sold(products, details)) == [("p4", "x", "cars")]
    assert rows(sales.top_products(products, details, k=2)) == [("p1", "car", 5), ("p2", "bus", 1)]


def test_unlisted_product_line_earns_nothing(products, details, table, rows):
    lines = table("productLine string", [("cars",)])
    assert rows(sales.top_product_line(lines, products, details)) == [("cars", Decimal("55.50"))]


def test_orders_per_month_clamps_the_look_back(table, rows):
    orders = table(
        "orderNumber int, orderDate date",
        [
            (1, dt.date(2003, 2, 27)),
            (2, dt.date(2003, 2, 28)),
            (3, dt.date(2003, 12, 1)),
            (4, dt.date(2003, 12, 31)),
        ],
    )
    found = sales.orders_per_month(orders, as_of=dt.date(2004, 2, 29))
    assert rows(found) == [("2003-02", 1), ("2003-12", 2)]


def test_customers_per_rep_keeps_idle_reps_and_null_names(employees, customers, rows):
    assert rows(sales.customers_per_rep(employees, customers)) == [
        (7, "Ann Lee", 2),
        (8, None, 1),
        (9, "Cy Poe", 0),
    ]


def test_customers_per_rep_is_ordered_by_count(employees, customers, table):
    more = customers.unionByName(table("customerNumber int, salesRepEmployeeNumber int", [(5, 8), (6, 8)]))
    assert [r.employeeNumber for r in sales.customers_per_rep(employees, more).collect()] == [8, 7, 9]
