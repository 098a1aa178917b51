"""One callable per registered query: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import changes, cleaning, dedup, fulfilment, grouping, joins, ranking
from tallyhouse.operators.lineage import shared_folder
from tallyhouse.operators.quality import HasType, foreign_key, key_rules, validate, validate_all
from tallyhouse.plans import gold, loyalty, revenue, sales
from tallyhouse.sources.buckets import BucketedState
from tallyhouse.streaming import batches, catchup
from workload.tables import (
    BATCH_ROWS,
    CHURN_DAYS,
    EVENT_MARK,
    LOYALTY_END,
    ORDER_STATUSES,
    ORDERS_AS_OF,
    PLANNED_ROWS,
    ROLLUP_MARK,
    SPECIAL_PRODUCT,
    Tables,
)

Query = Callable[[SparkSession, str], DataFrame]

LINE_SEQUENCE = ("placed_on", "cart_id", "line_no")
FEED_KEYS = ("customer_id", "priority")
FOLDERS = 16  # of tables kept by key


def _portable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: dates and times as text, exact decimals as doubles."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(c.alias(field.name))
    return df.select(*columns)


# --- patterns ---


def _staff(t: Tables) -> DataFrame:
    """Orders as pay slips: the priority class is the department, the price the salary."""
    return t.read("orders").select(
        F.col("o_orderkey").alias("emp"),
        F.col("o_orderpriority").alias("dept"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("salary"),
    )


def _with_unknown_statuses(t: Tables) -> DataFrame:
    lost = F.col("order_id") % 7 == 0
    return t.revenue_orders().withColumn("order_status", F.when(~lost, F.col("order_status")))


def _cleaned(t: Tables) -> DataFrame:
    return cleaning.clean_orders(t.raw_orders())


def _pay_order(name: str = "salary") -> list[tuple[str, bool]]:
    return [(name, True), ("emp", False)]


def _union_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    return (
        t.read("customer").select(F.col("c_nationkey").alias("nation_key")),
        t.read("supplier").select(F.col("s_nationkey").alias("nation_key")),
    )


def _union_by_name(t: Tables) -> DataFrame:
    return grouping.union_by_name(
        [
            t.read("customer").select(
                F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("c").alias("kind")
            ),
            t.read("supplier").select(
                F.lit("s").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
            ),
            t.read("part").select(
                F.col("p_name").alias("name"), F.lit("p").alias("kind"), F.col("p_partkey").alias("id")
            ),
        ]
    )


def _self_join(t: Tables) -> DataFrame:
    staff = t.read("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("manager_id"),
    )
    rooted = staff.withColumn("manager_id", F.when(F.col("id") != F.col("manager_id"), F.col("manager_id")))
    return joins.self_lookup(rooted, "manager_id", "id", {"name": "manager"}).select("name", "manager")


def _join_right(t: Tables) -> DataFrame:
    labels = t.read("labels").select("doc_id", "quality")
    return labels.join(t.read("documents").select("doc_id", "lang"), "doc_id", "right").select(
        "doc_id", "lang", "quality"
    )


def _join_full(t: Tables) -> DataFrame:
    old = t.feed(False).select(*FEED_KEYS, F.col("total").alias("old_total"))
    new = t.feed(True).select(*FEED_KEYS, F.col("total").alias("new_total"))
    return old.join(new, list(FEED_KEYS), "full")


def _join_cross(t: Tables) -> DataFrame:
    """Every customer paired with every declared status, with the revenue of the pair or 0."""
    pairs = joins.pair_with(
        t.read("customer").select(F.col("c_custkey").alias("customer_id")), "status", ORDER_STATUSES
    )
    paid = (
        t.revenue_orders()
        .groupBy(F.col("order_customer_id").alias("customer_id"), F.col("order_status").alias("status"))
        .agg(F.sum(F.col("sum").cast("decimal(18,2)")).alias("revenue"))
    )
    return pairs.join(paid, ["customer_id", "status"], "left").select(
        "customer_id", "status", F.coalesce("revenue", F.lit(0)).alias("revenue")
    )


# --- rollups ---


def _rolled(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: gold.ROLLUPS[name].delta(gold.with_month(t.silver_videos()))


def _two_totals(t: Tables, name: str) -> tuple[DataFrame, DataFrame]:
    videos = gold.with_month(t.silver_videos())
    mark = F.lit(ROLLUP_MARK.isoformat(sep=" ")).cast("timestamp_ntz")
    rollup = gold.ROLLUPS[name]
    return tuple(rollup.delta(videos.where(c)) for c in (F.col("publish_ts") <= mark, F.col("publish_ts") > mark))


def _rollup_merge(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: gold.ROLLUPS[name].merge(*_two_totals(t, name))


def _rollup_in_place(t: Tables) -> DataFrame:
    """Channel totals kept by key: the second step rewrites only the folders its channels fall in."""
    rollup = gold.CHANNEL_PERFORMANCE
    state = BucketedState(t.spark, shared_folder(t.spark, "channels"), rollup.keys, FOLDERS)
    for step, delta in enumerate(_two_totals(t, rollup.name), 1):
        state.apply(step, delta, rollup.merge)
    return state.read()


def _upsert_in_place(t: Tables) -> DataFrame:
    """The older feed as a stored table, the newer one merged into the folders its keys fall in."""

    def merge(held: DataFrame | None, delta: DataFrame) -> DataFrame:
        return delta if held is None else changes.merge_upsert(held, delta, FEED_KEYS)

    state = BucketedState(t.spark, shared_folder(t.spark, "feed"), FEED_KEYS, FOLDERS)
    state.apply(1, t.feed(False), merge)
    state.apply(2, t.feed(True), merge)
    return state.read()


def _distinct_videos(t: Tables) -> DataFrame:
    """Two batches that share five days, the later one merged twice: rows counted and videos counted."""
    videos, distinct = t.silver_videos(), gold.DISTINCT_VIDEOS
    mark = F.lit(ROLLUP_MARK.isoformat(sep=" ")).cast("timestamp_ntz")
    first = videos.where(F.col("publish_ts") <= mark)
    second = videos.where(F.col("publish_ts") > mark - F.expr("INTERVAL '5' DAY"))
    state, delta = distinct.delta(first), distinct.delta(second)
    estimate = distinct.estimate(distinct.merge(distinct.merge(state, delta), delta), "estimate")
    counted = first.unionByName(second).groupBy("country").agg(
        F.count("*").alias("row_count"), F.count_distinct("video_id").alias("distinct_videos")
    )
    error = F.abs(F.col("estimate") - F.col("distinct_videos"))
    return counted.join(estimate, "country").select(
        "country", "row_count", "distinct_videos", (error <= 0.02 * F.col("distinct_videos")).alias("within_2_percent")
    )


def _daily_sales(t: Tables) -> DataFrame:
    slips = t.revenue_orders().withColumn("sum", F.col("sum").cast("decimal(18,2)"))
    return grouping.daily_total(slips, "order_date", "sum")


# --- cleaning ---


def _clean_events(t: Tables) -> DataFrame:
    cleaned = cleaning.clean_videos(cleaning.with_publish_instant(t.raw_videos()))
    return cleaned.withColumn("publish_us", F.unix_micros("publish_ts")).drop("publish_ts")


def _clean_rejects(t: Tables) -> DataFrame:
    return cleaning.count_reasons(cleaning.judge_videos(cleaning.with_publish_instant(t.raw_videos())))


def _dedup_latest(t: Tables) -> DataFrame:
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    return dedup.latest_per_key(t.read("events").drop("props"), ["user_id"], newest)


# --- quality ---


def _dq_gold(t: Tables) -> DataFrame:
    """Videos of the error feed have lost their country, and the stored rollups hold the rows of one
    country twice: the key rules must report both."""
    videos = gold.with_month(
        t.silver_videos().withColumn("country", F.nullif("country", F.lit("error")))
    )
    tables = {name: r.delta(videos) for name, r in gold.ROLLUPS.items()}
    copies = F.when(F.col("country") == "click", F.lit(2)).otherwise(1)
    stored = {
        name: df.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy")
        for name, df in tables.items()
    }
    return validate_all(stored, gold.gold_suites())


def _dq_silver(t: Tables) -> DataFrame:
    """Likes above 90 were lost on the way."""
    videos = t.silver_videos()
    videos = videos.withColumn("likes", F.when(F.col("likes") <= 90, F.col("likes")))
    rules = gold.silver_suite(videos.columns)
    rules += [HasType("views", "bigint"), HasType("category_id", "bigint")]
    return validate(videos, rules, "silver_videos")


PRIMARY_KEYS = {
    "customer": ("c_custkey",),
    "orders": ("o_orderkey",),
    "part": ("p_partkey",),
    "supplier": ("s_suppkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
}

FOREIGN_KEYS = (
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("documents", "doc_id", "labels", "doc_id"),
)


def _dq_primary_key(t: Tables) -> DataFrame:
    return grouping.union_by_name(
        [validate(t.read(name), key_rules(*cols), name) for name, cols in PRIMARY_KEYS.items()]
    )


def _dq_foreign_key(t: Tables) -> DataFrame:
    return grouping.union_by_name(
        [foreign_key(t.read(c), fk, t.read(p), pk, c) for c, fk, p, pk in FOREIGN_KEYS]
    )


# --- incremental ---


def _hourly(t: Tables) -> DataFrame:
    """Events with their time cut to the hour, so that many share one."""
    return t.read("events").select(
        "event_id",
        "event_type",
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("publish_ts"),
    )


def _incr_batch(t: Tables) -> DataFrame:
    events = t.read("events").select("event_id", "event_type", F.col("ts").alias("publish_ts"))
    return batches.next_batch(events, "publish_ts", ["event_id"], EVENT_MARK, BATCH_ROWS)


def _incr_batch_ties(t: Tables) -> DataFrame:
    return batches.next_batch_whole(_hourly(t), "publish_ts", EVENT_MARK, BATCH_ROWS)


def _incr_plan(t: Tables) -> DataFrame:
    plan = catchup.plan_batches(_hourly(t), "publish_ts", EVENT_MARK, PLANNED_ROWS)
    return plan.select("batch", "after", F.col("upto").alias("border"), "rows")


def _incr_late_dropped(t: Tables) -> DataFrame:
    events = _hourly(t)
    late = batches.late_rows(events, "publish_ts", EVENT_MARK)
    return events.groupBy("event_type").agg(
        F.count_if(late).alias("dropped"), F.count_if(~late).alias("readable")
    )


# --- fulfilment ---


def _filled(t: Tables) -> DataFrame:
    return fulfilment.fill_lines(t.cart_lines(), t.items(), LINE_SEQUENCE)


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # loyalty
    "spend_per_customer": lambda t: loyalty.spend_per_customer(t.loyalty_sales(), t.menu()),
    "visit_days": lambda t: loyalty.visit_days(t.loyalty_sales()),
    "first_item_rowvalue": lambda t: loyalty.first_item_rowvalue(t.order_sales(), t.menu()),
    "first_item_true": lambda t: loyalty.first_item_true(t.order_sales(), t.menu()),
    "most_purchased": lambda t: loyalty.most_purchased(t.loyalty_sales(), t.menu()),
    "top_item_per_customer": lambda t: loyalty.top_item_per_customer(t.loyalty_sales(), t.menu()),
    "first_item_after": lambda t: loyalty.first_item_after(
        t.loyalty_sales(), t.menu(), t.members()
    ),
    "last_item_before": lambda t: loyalty.last_item_before(
        t.loyalty_sales(), t.menu(), t.members()
    ),
    "before_member_totals": lambda t: loyalty.before_member_totals(
        t.loyalty_sales(), t.menu(), t.members()
    ),
    "points_sushi": lambda t: loyalty.points_sushi(t.loyalty_sales(), t.menu(), SPECIAL_PRODUCT),
    "points_first_week": lambda t: loyalty.points_first_week(
        t.loyalty_sales(), t.menu(), t.members(), LOYALTY_END, SPECIAL_PRODUCT
    ),
    "top5_payers": lambda t: loyalty.top5_payers(t.loyalty_sales(), t.menu()),
    # sales model
    "top_reps": lambda t: sales.top_reps(
        t.employees(), t.customers(), t.orders(), t.order_details()
    ),
    "top_product_line": lambda t: sales.top_product_line(
        t.product_lines(), t.products(), t.order_details()
    ),
    "never_sold": lambda t: sales.never_sold(t.library_products(), t.library_sales()),
    "orders_per_month": lambda t: sales.orders_per_month(t.orders(), ORDERS_AS_OF),
    "top_products": lambda t: sales.top_products(t.products(), t.order_details()),
    "customers_per_rep": lambda t: sales.customers_per_rep(t.employees(), t.customers()),
    # order analytics
    "customer_revenue_rank": lambda t: revenue.customer_revenue_rank(t.revenue_orders()),
    "status_pivot": lambda t: revenue.status_pivot(_with_unknown_statuses(t), ORDER_STATUSES[:2]),
    "status_pivot_all": lambda t: revenue.status_pivot(_with_unknown_statuses(t)),
    "monthly_revenue": lambda t: revenue.monthly_revenue(t.revenue_orders()),
    "last_order_per_customer": lambda t: revenue.last_order_per_customer(t.revenue_orders()),
    "churned": lambda t: revenue.churned(t.revenue_orders(), CHURN_DAYS),
    # rollups
    "gold_channel_performance": _rolled("channel_performance"),
    "gold_category_performance": _rolled("category_performance"),
    "gold_monthly_trending": _rolled("monthly_trending"),
    "gold_overall_kpis": _rolled("overall_kpis"),
    "gold_channel_country": _rolled("channel_country"),
    "rollup_merge": _rollup_merge("channel_performance"),
    "rollup_merge_category_performance": _rollup_merge("category_performance"),
    "rollup_merge_monthly_trending": _rollup_merge("monthly_trending"),
    "rollup_merge_overall_kpis": _rollup_merge("overall_kpis"),
    "rollup_merge_channel_country": _rollup_merge("channel_country"),
    "rollup_merge_in_place": _rollup_in_place,
    "gold_distinct_videos": _distinct_videos,
    "daily_sales": _daily_sales,
    # patterns
    "above_group_avg": lambda t: ranking.above_group_mean(_staff(t), ["dept"], "salary"),
    "self_join": _self_join,
    "join_right": _join_right,
    "join_full": _join_full,
    "join_cross": _join_cross,
    "sum_over": lambda t: ranking.with_group_value(
        _staff(t), ["dept"], F.sum("salary"), "dept_total"
    ),
    "row_number": lambda t: ranking.with_row_number(_staff(t), _pay_order(), ["dept"]),
    "rank": lambda t: ranking.with_rank(_staff(t), "salary"),
    "dense_rank": lambda t: ranking.with_rank(
        _staff(t), "salary", ["dept"], "dense_rank", dense=True
    ),
    "ntile": lambda t: ranking.with_ntile(_staff(t), 4, _pay_order(), ["dept"]),
    "nth_per_group": lambda t: ranking.nth_value_rows(
        _staff(t).select("dept", "salary"), ["dept"], "salary", 3
    ),
    "third_highest": lambda t: ranking.top_rows(_staff(t), "salary", ["emp"], 1, skip=2).select(
        "salary"
    ),
    "dup_one": lambda t: grouping.duplicates(t.read("documents"), ["text"]),
    "dup_multi": lambda t: grouping.duplicates(t.read("lineitem"), ["l_orderkey", "l_linenumber"]),
    "union_all": lambda t: _union_inputs(t)[0].union(_union_inputs(t)[1]),
    "union_distinct": lambda t: _union_inputs(t)[0].union(_union_inputs(t)[1]).distinct(),
    "union_by_name": _union_by_name,
    # cleaning
    "clean_orders": lambda t: cleaning.clean_orders(t.raw_orders()),
    "clean_customer_revenue_rank": lambda t: revenue.customer_revenue_rank(_cleaned(t)),
    "clean_monthly_revenue": lambda t: revenue.monthly_revenue(_cleaned(t)),
    "clean_churned": lambda t: revenue.churned(_cleaned(t), CHURN_DAYS),
    "clean_status_pivot": lambda t: revenue.status_pivot(_cleaned(t), ["o"]),
    "clean_audit": lambda t: cleaning.audit_orders(t.raw_orders()),
    "clean_events": _clean_events,
    "clean_rejects": _clean_rejects,
    "dedup_full": lambda t: dedup.distinct_rows(t.read("documents").select("text", "lang", "source")),
    "dedup_latest": _dedup_latest,
    # table changes
    "merge_upsert": lambda t: changes.merge_upsert(t.feed(False), t.feed(True), FEED_KEYS),
    "merge_upsert_in_place": _upsert_in_place,
    "delete_missing": lambda t: changes.delete_missing(t.feed(False), t.feed(True), FEED_KEYS),
    "full_sync": lambda t: changes.full_sync(t.feed(False), t.feed(True), FEED_KEYS).orderBy(*FEED_KEYS),
    "delete_where": lambda t: changes.delete_where(
        t.feed(True).drop("last_order", "total"), F.col("status") == "F"
    ),
    # quality
    "dq_gold": _dq_gold,
    "dq_silver": _dq_silver,
    "dq_primary_key": _dq_primary_key,
    "dq_foreign_key": _dq_foreign_key,
    # incremental
    "incr_batch": _incr_batch,
    "incr_batch_ties": _incr_batch_ties,
    "incr_late_dropped": _incr_late_dropped,
    "incr_plan": _incr_plan,
    # fulfilment
    "cart_rejects": lambda t: fulfilment.rejected_lines(t.cart_lines(), t.items()),
    "cart_accepted": _filled,
    "cart_remaining": lambda t: fulfilment.remaining_stock(t.items(), _filled(t)),
    "cart_delivery": lambda t: fulfilment.delivery(t.carts()),
    "cart_bill": lambda t: fulfilment.bills(_filled(t), t.items(), t.carts()),
    "inventory_after": lambda t: fulfilment.inventory_after(t.items(), _filled(t)),
}


def _bind(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: _portable(build(Tables(spark, folder)))


def queries() -> dict[str, Query]:
    return {name: _bind(build) for name, build in QUERIES.items()}
