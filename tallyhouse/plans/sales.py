"""Questions over a product sales model: employees, customers, orders, order details, products.

Order details are summed up along the join path, so each join meets one row per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import full_name, months_before, year_month
from tallyhouse.operators.joins import without_match
from tallyhouse.operators.ranking import top_rows


def _revenue(details: DataFrame, key: str) -> DataFrame:
    value = F.col("quantityOrdered") * F.col("priceEach")
    return details.groupBy(key).agg(F.sum(value).alias("revenue"))


def top_reps(
    employees: DataFrame, customers: DataFrame, orders: DataFrame, details: DataFrame, k: int = 5
) -> DataFrame:
    """Sales representatives by the revenue of their customers."""
    per_customer = (
        _revenue(details, "orderNumber")
        .join(orders.select("orderNumber", "customerNumber"), "orderNumber")
        .groupBy("customerNumber")
        .agg(F.sum("revenue").alias("revenue"))
    )
    per_rep = (
        per_customer.join(customers, "customerNumber")
        .groupBy(F.col("salesRepEmployeeNumber").alias("employeeNumber"))
        .agg(F.sum("revenue").alias("totalRevenue"))
    )
    named = per_rep.join(employees, "employeeNumber").select(
        "employeeNumber", "firstName", "lastName", "totalRevenue"
    )
    return top_rows(named, "totalRevenue", ["employeeNumber"], k)


def top_product_line(
    product_lines: DataFrame, products: DataFrame, details: DataFrame, k: int = 1
) -> DataFrame:
    per_line = (
        _revenue(details, "productCode")
        .join(products, "productCode")
        .groupBy("productLine")
        .agg(F.sum("revenue").alias("totalRevenue"))
    )
    listed = per_line.join(product_lines.select("productLine"), "productLine")
    return top_rows(listed, "totalRevenue", ["productLine"], k)


def never_sold(products: DataFrame, details: DataFrame) -> DataFrame:
    return without_match(products, details, {"productCode": "productCode"}).select(
        "productCode", "productName", "productLine"
    )


def orders_per_month(orders: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    """Order counts per month from ``months`` before the given day on."""
    since = months_before(as_of, months).cast(orders.schema["orderDate"].dataType)
    return (
        orders.where(F.col("orderDate") >= since)
        .groupBy(year_month("orderDate").alias("yearMonth"))
        .agg(F.count("*").alias("ordersCount"))
        .orderBy("yearMonth")
    )


def top_products(products: DataFrame, details: DataFrame, k: int = 10) -> DataFrame:
    sold = details.groupBy("productCode").agg(F.sum("quantityOrdered").alias("total_quantity"))
    named = sold.join(products, "productCode").select(
        "productCode", "productName", "total_quantity"
    )
    return top_rows(named, "total_quantity", ["productCode"], k)


def customers_per_rep(employees: DataFrame, customers: DataFrame) -> DataFrame:
    """Every employee with the number of customers served, 0 included, most customers first."""
    served = customers.groupBy(F.col("salesRepEmployeeNumber").alias("employeeNumber")).agg(
        F.count("customerNumber").alias("n")
    )
    return employees.join(served, "employeeNumber", "left").select(
        "employeeNumber",
        full_name("firstName", "lastName").alias("employeeName"),
        F.coalesce("n", F.lit(0)).alias("customerCount"),
    ).orderBy(F.col("customerCount").desc(), "employeeNumber")
