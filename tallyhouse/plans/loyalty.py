"""Restaurant loyalty questions over sales, menu and members.

sales(customer_id, order_date, product_id), menu(product_id, product_name, price) with one row per
product, members(customer_id, join_date).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.asof import first_on_or_after, last_before
from tallyhouse.operators.joins import BROADCAST_ROWS, small_side
from tallyhouse.operators.ranking import leaders, top_rows

POINTS_PER_UNIT = 10
BONUS = 2
FIRST_WEEK_DAYS = 6


def _sold(sales: DataFrame, *by: str) -> DataFrame:
    """Sales counted (``sold``) per product and the given columns, so that the join with the menu meets
    a busy product once per customer and not once per sale."""
    return sales.groupBy(*by, "product_id").agg(F.count(F.lit(1)).alias("sold"))


def spend_per_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return (
        _sold(sales, "customer_id")
        .join(menu, "product_id")
        .groupBy("customer_id")
        .agg(F.sum(F.col("price") * F.col("sold")).alias("total_amount_spent"))
    )


def visit_days(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(F.count_distinct("order_date").alias("visit_days"))


def first_item_rowvalue(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Sales that are on the customer's first day and of the customer's lowest product id.

    Both minima are taken on their own, so a customer whose lowest product was not bought on the
    first day is absent.
    """
    firsts = sales.groupBy("customer_id").agg(
        F.min("order_date").alias("order_date"), F.min("product_id").alias("product_id")
    )
    return (
        sales.join(firsts, ["customer_id", "order_date", "product_id"], "left_semi")
        .join(menu, "product_id")
        .select("customer_id", F.col("product_name").alias("first_item"))
    )


def first_item_true(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """One first purchase per customer: earliest day, lowest product id on that day."""
    first = sales.groupBy("customer_id").agg(
        F.min(F.struct("order_date", "product_id")).alias("first")
    )
    return first.select("customer_id", "first.product_id").join(menu, "product_id").select(
        "customer_id", F.col("product_name").alias("first_item")
    )


def most_purchased(sales: DataFrame, menu: DataFrame, k: int = 1) -> DataFrame:
    """Counted per product id before names are joined in, so the join sees each product once."""
    sold = sales.groupBy("product_id").agg(F.count("*").alias("n"))
    named = (
        sold.join(menu, "product_id")
        .groupBy("product_name")
        .agg(F.sum("n").alias("times_purchased"))
    )
    return top_rows(named, "times_purchased", ["product_name"], k)


def top_item_per_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    counted = (
        _sold(sales, "customer_id")
        .join(menu, "product_id")
        .groupBy("customer_id", "product_name")
        .agg(F.sum("sold").alias("total_ordered"))
    )
    return leaders(counted, ["customer_id"], "total_ordered").orderBy("customer_id", "product_name")


def first_item_after(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """The day is chosen before the menu is joined: an unlisted product is not replaced."""
    found = first_on_or_after(sales, members, "customer_id", "order_date", "join_date")
    return found.join(menu, "product_id").select(
        "customer_id", F.col("product_name").alias("FirstProduct"), "order_date"
    ).orderBy("customer_id", "order_date", "FirstProduct")


def last_item_before(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    found = last_before(sales, members, "customer_id", "order_date", "join_date")
    return found.join(menu, "product_id").select(
        "customer_id", F.col("product_name").alias("ProductBeforeMem"), "order_date"
    ).orderBy("customer_id", "order_date", "ProductBeforeMem")


def _with_membership(
    bought: DataFrame, members: DataFrame, totals: list[str], broadcast_rows: int
) -> DataFrame:
    """Purchases with their customer's join date.

    Few members are broadcast. Many are joined with customer-day totals, so that a busy customer
    reaches the join, and the grouping by customer after it, with one row per day.
    """
    members = members.select("customer_id", "join_date")
    small = small_side(members, broadcast_rows)
    if small is not None:
        return bought.join(small, "customer_id")
    days = bought.groupBy("customer_id", "order_date").agg(*[F.sum(t).alias(t) for t in totals])
    return days.join(members, "customer_id")


def before_member_totals(
    sales: DataFrame, menu: DataFrame, members: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Members without earlier purchases stay, with 0 items and a NULL amount.

    The date range is applied in an inner join, where either side may be broadcast; the members
    it loses come back in an outer join of one row per customer.
    """
    bought = _sold(sales, "customer_id", "order_date").join(menu, "product_id", "left").select(
        "customer_id",
        "order_date",
        F.when(F.col("product_id").isNotNull(), F.col("sold")).otherwise(0).alias("n"),
        (F.col("price") * F.col("sold")).alias("amount"),
    )
    totals = (
        _with_membership(bought, members, ["n", "amount"], broadcast_rows)
        .where(F.col("order_date") < F.col("join_date"))
        .groupBy("customer_id")
        .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount_spent"))
    )
    return (
        members.select("customer_id")
        .distinct()
        .join(totals, "customer_id", "left")
        .select("customer_id", F.coalesce("n", F.lit(0)).alias("total_items"), "amount_spent")
        .orderBy("customer_id")
    )


def points_sushi(sales: DataFrame, menu: DataFrame, special: str = "sushi") -> DataFrame:
    """Points per unit of price, doubled on one product."""
    factor = F.when(F.col("product_name") == special, BONUS).otherwise(1)
    return (
        _sold(sales, "customer_id")
        .join(menu, "product_id")
        .groupBy("customer_id")
        .agg(F.sum(F.col("price") * F.col("sold") * POINTS_PER_UNIT * factor).alias("total_points"))
        .orderBy("customer_id")
    )


def points_first_week(
    sales: DataFrame,
    menu: DataFrame,
    members: DataFrame,
    until: dt.date,
    special: str = "sushi",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Points of members up to a day: all items doubled from the join day for seven days, the
    special product doubled always. Purchases before joining count too."""
    is_special = F.col("product_name") == special
    bought = (
        _sold(sales.where(F.col("order_date") <= F.lit(until)), "customer_id", "order_date")
        .join(menu, "product_id")
        .withColumn("amount", F.col("price") * F.col("sold"))
        .select(
            "customer_id",
            "order_date",
            "amount",
            F.when(is_special, F.col("amount")).otherwise(0).alias("special_amount"),
        )
    )
    in_week = F.col("order_date").between(
        F.col("join_date"), F.date_add("join_date", FIRST_WEEK_DAYS)
    )
    weighted = F.when(in_week, F.col("amount") * BONUS).otherwise(
        F.col("amount") + F.col("special_amount") * (BONUS - 1)
    )
    return (
        _with_membership(bought, members, ["amount", "special_amount"], broadcast_rows)
        .groupBy("customer_id")
        .agg(F.sum(weighted * POINTS_PER_UNIT).alias("total_points"))
        .orderBy("customer_id")
    )


def top5_payers(sales: DataFrame, menu: DataFrame, k: int = 5) -> DataFrame:
    paid = spend_per_customer(sales, menu).withColumnRenamed("total_amount_spent", "total_amount")
    return top_rows(paid, "total_amount", ["customer_id"], k)
