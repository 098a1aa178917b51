"""Order fulfilment in bulk: screen lines, hand out stock in order, price carts, write stock back.

Tables: lines(cart_id, item_id, qty, <sequence columns>), items(item_id, name, price, stock),
carts(cart_id, distance_km).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import delivery_charge
from tallyhouse.operators.joins import is_small
from tallyhouse.operators.lineage import saved
from tallyhouse.operators.ranking import with_running_total

FEW_LINES = 512  # open lines of an item that are folded in one row


def screen_lines(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Add ``reason``: NULL for a usable line, else why it cannot be filled."""
    known = items.select("item_id", F.lit(True).alias("__known"))
    reason = F.when(F.col("__known").isNull(), "unknown item").when(
        F.col("qty") <= 0, "quantity not positive"
    )
    return lines.join(known, "item_id", "left").withColumn("reason", reason).drop("__known")


def rejected_lines(lines: DataFrame, items: DataFrame) -> DataFrame:
    return screen_lines(lines, items).where(F.col("reason").isNotNull())


def _round(open_lines: DataFrame, sequence: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One round over the open lines of many items: (lines filled, lines still open).

    Every item fills its lines in order up to the first shortage: the lines whose running total stays
    within what is left of it. A refused quantity stays refused, so lines that ask for more than what
    is left then are closed too, the line of the shortage among them.
    """
    order = [(c, False) for c in sequence]
    totalled = saved(with_running_total(open_lines, "qty", order, ["item_id"], "__asked"))
    fits = F.col("__asked") <= F.col("__stock")
    used = totalled.where(fits).groupBy("item_id").agg(F.max("__asked").alias("__used"))
    later = totalled.where(~fits).drop("__asked").join(used, "item_id", "left")
    later = later.withColumn("__stock", F.col("__stock") - F.coalesce("__used", F.lit(0))).drop("__used")
    return totalled.where(fits).drop("__asked"), later.where(F.col("qty") <= F.col("__stock"))


def _one_by_one(open_lines: DataFrame, sequence: Sequence[str]) -> DataFrame:
    """The lines filled of items with few open lines: each item's lines are folded in one row."""
    columns = open_lines.columns
    listed = open_lines.groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct(*sequence, F.struct(*columns).alias("__line")))).alias("lines"),
        F.max("__stock").alias("left"),
    )
    start = F.struct(
        F.col("left").cast("bigint").alias("left"), F.lit(1).alias("at"), F.array().cast("array<int>").alias("taken")
    )

    def step(done, line):
        qty = line["__line"]["qty"].cast("bigint")
        enough = qty <= done["left"]
        return F.struct(
            F.when(enough, done["left"] - qty).otherwise(done["left"]).alias("left"),
            (done["at"] + 1).alias("at"),
            F.when(enough, F.concat(done["taken"], F.array(done["at"]))).otherwise(done["taken"]).alias("taken"),
        )

    taken = F.aggregate("lines", start, step)["taken"]
    filled = listed.select("lines", F.explode(taken).alias("nth"))
    return filled.select(F.element_at("lines", F.col("nth"))["__line"].alias("line")).select(
        *[F.col("line")[c].alias(c) for c in columns]
    )


def fill_lines(
    lines: DataFrame, items: DataFrame, sequence: Sequence[str], few: int = FEW_LINES
) -> DataFrame:
    """The lines that get stock when each item serves its lines in sequence order.

    A line is filled when its quantity is still there, and only filled lines use stock. Items with at
    most ``few`` open lines are folded, one row each. All others go through rounds together: a round
    fills every item up to its first shortage by running totals over range partitions, and closes the
    lines that ask for more than what is left. Rounds go on until no item has more than ``few`` open
    lines; each closes at least the line of the shortage. No line is gathered with more than ``few`` others.

    ``sequence`` must order the lines of an item uniquely. Lines without an item, of an unknown item or with a
    quantity that is not positive are not filled.
    """
    stock = items.select("item_id", F.col("stock").alias("__stock"))
    usable = lines.where((F.col("qty") > 0) & F.col("item_id").isNotNull()).join(stock, "item_id")
    open_lines = usable.where(F.col("qty") <= F.col("__stock")).select(*lines.columns, "__stock")
    filled = []
    while True:
        busy = open_lines.groupBy("item_id").agg(F.count("*").alias("n")).where(F.col("n") > few).select("item_id")
        busy = saved(busy)  # at most one for every ``few`` lines
        if busy.isEmpty():
            filled.append(_one_by_one(open_lines, sequence))
            return reduce(DataFrame.unionByName, filled).select(*lines.columns)
        near = F.broadcast(busy) if is_small(busy) else busy
        filled.append(_one_by_one(open_lines.join(near, "item_id", "left_anti"), sequence))
        done, open_lines = _round(open_lines.join(near, "item_id", "left_semi"), sequence)
        filled.append(done)
        open_lines = saved(open_lines)


def remaining_stock(items: DataFrame, filled: DataFrame) -> DataFrame:
    """(item_id, remaining) for every item, also those nobody asked for."""
    used = filled.groupBy("item_id").agg(F.sum("qty").alias("__used"))
    return items.join(used, "item_id", "left").select(
        "item_id", (F.col("stock") - F.coalesce("__used", F.lit(0))).alias("remaining")
    )


def inventory_after(items: DataFrame, filled: DataFrame) -> DataFrame:
    """The item table with stock written back."""
    used = filled.groupBy("item_id").agg(F.sum("qty").alias("__used"))
    left = (F.col("stock") - F.coalesce("__used", F.lit(0))).alias("stock")
    return items.join(used, "item_id", "left").select(
        *[left if c == "stock" else F.col(c) for c in items.columns]
    )


def price_lines(filled: DataFrame, items: DataFrame) -> DataFrame:
    priced = filled.join(items.select("item_id", "price"), "item_id")
    return priced.withColumn("line_total", F.col("price") * F.col("qty"))


def delivery(carts: DataFrame) -> DataFrame:
    return carts.withColumn("delivery", delivery_charge("distance_km"))


def bills(filled: DataFrame, items: DataFrame, carts: DataFrame) -> DataFrame:
    """(cart_id, goods, delivery, total); a cart with no filled line gets no bill."""
    goods = price_lines(filled, items).groupBy("cart_id").agg(F.sum("line_total").alias("goods"))
    return (
        delivery(carts)
        .join(goods, "cart_id")
        .select("cart_id", "goods", "delivery", (F.col("goods") + F.col("delivery")).alias("total"))
    )
