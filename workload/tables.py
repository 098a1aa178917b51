"""The supplied tables seen as the tables the plans expect.

All views read whole tables. Where the supplied data has no matching column one is computed from
others, with the same expression in the SQL counterpart (``oracles.py``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse.functions import money
from tallyhouse.operators.grouping import union_by_name

SPECIAL_PRODUCT = "PROMO"
LOYALTY_END = dt.date(1998, 12, 31)
ORDERS_AS_OF = dt.date(2001, 8, 1)
CHURN_DAYS = 300
ORDER_STATUSES = ("f", "o", "p")
FEED_CUTOFF = dt.datetime(1998, 4, 1)
EVENT_MARK = dt.datetime(2024, 1, 3, 12)
ROLLUP_MARK = dt.datetime(2024, 1, 16)
BATCH_ROWS = 5_000
PLANNED_ROWS = 100


_SCHEMAS: dict[str, StructType] = {}


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        """The footer of a table is read for its schema once, however often a query scans it."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # --- loyalty: a supplier buys what its order lines ship ---

    def loyalty_sales(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_suppkey").alias("customer_id"),
            F.to_date("l_shipdate").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
        )

    def order_sales(self) -> DataFrame:
        """Every order as a buyer of its own, for questions that need buyers with few sales."""
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("customer_id"),
            F.to_date("l_shipdate").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
        )

    def menu(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_name"),
            money("p_retailprice", 10).alias("price"),
        )

    def members(self) -> DataFrame:
        """Suppliers in credit; join dates spread over four years, some before any sale."""
        joined = F.date_add(F.lit(dt.date(1994, 12, 1)), (F.col("s_suppkey") * 37 % 1400).cast("int"))
        return (
            self.read("supplier")
            .where("s_acctbal > 0")
            .select(F.col("s_suppkey").alias("customer_id"), joined.alias("join_date"))
        )

    # --- sales model ---

    def employees(self) -> DataFrame:
        nation = self.read("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return self.read("supplier").join(nation, "s_nationkey").select(
            F.col("s_suppkey").alias("employeeNumber"),
            F.col("s_name").alias("firstName"),
            F.col("n_name").alias("lastName"),
        )

    def customers(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("customerNumber"),
            F.col("c_nationkey").cast("bigint").alias("salesRepEmployeeNumber"),
        )

    def orders(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("orderNumber"),
            F.col("o_custkey").alias("customerNumber"),
            F.col("o_orderdate").alias("orderDate"),
        )

    def order_details(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("orderNumber"),
            F.col("l_partkey").alias("productCode"),
            F.col("l_quantity").cast("int").alias("quantityOrdered"),
            money("l_extendedprice", 12).alias("priceEach"),
        )

    def products(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("productCode"),
            F.col("p_name").alias("productName"),
            F.col("p_brand").alias("productLine"),
        )

    def product_lines(self) -> DataFrame:
        return self.products().select("productLine").distinct()

    def library_products(self) -> DataFrame:
        """Documents as products: every part is sold, but not every document is labelled."""
        return self.read("documents").select(
            F.col("doc_id").alias("productCode"),
            F.col("source").alias("productName"),
            F.col("lang").alias("productLine"),
        )

    def library_sales(self) -> DataFrame:
        return self.read("labels").select(F.col("doc_id").alias("productCode"))

    # --- order analytics ---

    def revenue_orders(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("order_customer_id"),
            F.col("o_totalprice").alias("sum"),
            F.to_date("o_orderdate").alias("order_date"),
            F.lower("o_orderstatus").alias("order_status"),
        )

    def raw_orders(self) -> DataFrame:
        """Orders as a dirty text file: bad ids, other date styles, gaps, negative sums, and a
        second delivery of finished orders whose status differs in case and blanks only."""
        o = self.read("orders")
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        amount = money("o_totalprice", 12).cast("string")
        low_open = (priority == "5-LOW") & (status == "O")
        first = o.select(
            F.when((priority == "1-URGENT") & (status == "P"), F.lit("x"))
            .otherwise(F.col("o_orderkey").cast("string"))
            .alias("order_id"),
            F.when(low_open, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
            .alias("order_date"),
            F.col("o_custkey").cast("string").alias("order_customer_id"),
            status.alias("order_status"),
            F.when((priority == "2-HIGH") & (status == "P"), F.lit(None))
            .when((priority == "3-MEDIUM") & (status == "P"), F.concat(F.lit("-"), amount))
            .otherwise(amount)
            .alias("sum"),
        )
        again = first.where("order_status = 'F'").withColumn(
            "order_status", F.concat(F.lit(" "), F.lower("order_status"), F.lit(" "))
        )
        return union_by_name([first, again])

    # --- videos: events as video statistics, one country per event type ---

    def silver_videos(self) -> DataFrame:
        e = F.col("event_id")
        return self.read("events").select(
            e.alias("video_id"),
            F.col("user_id").alias("channel_title"),
            F.col("event_type").alias("country"),
            (e % 7).cast("int").alias("category_id"),
            F.floor("value").alias("views"),
            (e % 101).alias("likes"),
            (e % 13).alias("dislikes"),
            (e % 29).alias("comment_count"),
            F.add_months(F.to_date("ts"), (e % 12).cast("int")).alias("trending_date"),
            F.col("ts").alias("publish_ts"),
        )

    def raw_videos(self) -> DataFrame:
        """Events as raw text statistics: unreadable counts and flags, gaps, and a later second
        crawl of every purchase."""
        e, kind, value = F.col("event_id"), F.col("event_type"), F.floor("value")
        events = self.read("events")
        first = events.select(
            kind,
            e.cast("string").alias("video_id"),
            F.col("user_id").cast("string").alias("channel_title"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("publish_time"),
            F.date_format("ts", "yy.dd.MM").alias("trending_date"),
            (e % 7).cast("string").alias("category_id"),
            F.when(value < 5, F.lit("n/a")).otherwise(value.cast("string")).alias("views"),
            (e % 101).cast("string").alias("likes"),
            F.when(value > 200, F.lit(None)).otherwise((e % 13).cast("string")).alias("dislikes"),
            (e % 29).cast("string").alias("comment_count"),
            F.when(kind == "click", "true").otherwise("false").alias("comments_disabled"),
            F.when((kind == "error") & (value < 20), "unknown")
            .otherwise("False")
            .alias("ratings_disabled"),
            F.when(kind == "error", "TRUE").otherwise("FALSE").alias("video_error_or_removed"),
        )
        second = first.where("event_type = 'purchase'").withColumns(
            {
                "publish_time": F.concat(
                    F.lit("2024-03-01T"), F.substring("publish_time", 12, 20)
                ),
                "views": F.lit("1000"),
            }
        )
        return union_by_name([first, second]).drop("event_type")

    # --- synchronisation: two order feeds per customer and priority ---

    def feed(self, newer: bool) -> DataFrame:
        """Last order of each (customer, priority) before or from the cutoff on; the newer feed
        does not know the status of pending orders."""
        day = F.col("o_orderdate")
        cutoff = F.lit(FEED_CUTOFF.isoformat(sep=" ")).cast("timestamp_ntz")
        rows = self.read("orders").where(day >= cutoff if newer else day < cutoff)
        last = rows.groupBy(
            F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("priority")
        ).agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")).alias("o"))
        status = F.nullif("o.o_orderstatus", F.lit("P")) if newer else F.col("o.o_orderstatus")
        return last.select(
            "customer_id",
            "priority",
            F.col("o.o_orderkey").alias("last_order"),
            status.alias("status"),
            F.col("o.o_totalprice").alias("total"),
        )

    # --- fulfilment: lineitem asks parts for stock; returned lines carry negative quantities ---

    def items(self) -> DataFrame:
        """The catalogue without discontinued economy parts."""
        return (
            self.read("part")
            .where("p_type <> 'ECONOMY'")
            .select(
                F.col("p_partkey").alias("item_id"),
                F.col("p_name").alias("name"),
                money("p_retailprice", 10).alias("price"),
                (F.col("p_size") * 20).alias("stock"),
            )
        )

    def cart_lines(self) -> DataFrame:
        qty = F.col("l_quantity").cast("int")
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("cart_id"),
            F.col("l_linenumber").alias("line_no"),
            F.to_date("l_shipdate").alias("placed_on"),
            F.col("l_partkey").alias("item_id"),
            F.when(F.col("l_returnflag") == "R", -qty).otherwise(qty).alias("qty"),
        )

    def carts(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("cart_id"), (F.col("o_custkey") % 45).alias("distance_km")
        )
