"""Revenue questions over cleaned orders(order_id, order_customer_id, sum, order_date, order_status)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import days_between, precise, year_month
from tallyhouse.operators.grouping import pivot_total
from tallyhouse.operators.ranking import with_rank


def customer_revenue_rank(orders: DataFrame) -> DataFrame:
    revenue = orders.groupBy("order_customer_id").agg(F.sum(precise("sum")).alias("total_revenue"))
    return with_rank(revenue, "total_revenue", name="rank", save=True)


def status_pivot(orders: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Revenue per customer with one column per status, and ``other`` for NULL and undeclared ones.

    NULL where a customer has none. Without ``statuses`` those in the table are looked up.
    """
    exact = orders.withColumn("sum", precise("sum"))
    return pivot_total(exact, "order_customer_id", "order_status", "sum", statuses)


def monthly_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy(year_month("order_date").alias("year_month")).agg(
        F.sum(precise("sum")).alias("monthly_revenue")
    ).orderBy("year_month")


def last_order_per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_customer_id").agg(F.max("order_date").alias("last_order_date"))


def churned(orders: DataFrame, days: int) -> DataFrame:
    """Customers silent for more than ``days`` before the newest order of the whole table."""
    last = last_order_per_customer(orders)
    newest = last.agg(F.max("last_order_date").alias("newest"))
    silent = days_between(newest.scalar(), "last_order_date")
    return last.withColumn("days_since_last_order", silent).where(
        F.col("days_since_last_order") > days
    )
