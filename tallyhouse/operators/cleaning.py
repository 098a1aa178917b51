"""Cleaning of raw order files and of raw video statistics.

Values that cannot be read become NULL and are removed by the null filter, not raised.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import (
    as_boolean,
    as_double,
    as_int,
    as_long,
    clean_text,
    parse_day,
    parse_instant,
)
from tallyhouse.operators.dedup import distinct_rows, latest_per_key

ORDER_DAY = "dd-MM-yyyy"
# Year, then day, then month.
TRENDING_DAY = "yy.dd.MM"

VIDEO_COUNTS = ("views", "likes", "dislikes", "comment_count")
VIDEO_FLAGS = ("comments_disabled", "ratings_disabled", "video_error_or_removed")


def typed_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        as_int("order_id").alias("order_id"),
        as_int("order_customer_id").alias("order_customer_id"),
        as_double("sum").alias("sum"),
        parse_day("order_date", ORDER_DAY).alias("order_date"),
        clean_text("order_status").alias("order_status"),
    )


def _complete(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


LARGEST_SUM = 1e15  # from here on, and for NaN, an amount is no amount


def _valid_order() -> Column:
    """NaN compares as larger than any number."""
    amount = (F.col("sum") >= 0) & (F.col("sum") < LARGEST_SUM)
    return (F.col("order_id") > 0) & (F.col("order_customer_id") > 0) & amount


def clean_orders(raw: DataFrame) -> DataFrame:
    """Cast, drop repeated rows, drop incomplete rows, drop rows with impossible numbers."""
    typed = typed_orders(raw)
    return distinct_rows(typed).where(_complete(typed.columns)).where(_valid_order())


def audit_orders(raw: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, as (step_no, step, n_rows), from one pass."""
    typed = typed_orders(raw)
    unique = typed.groupBy(*typed.columns).agg(F.count("*").alias("__copies"))
    complete = _complete(typed.columns)
    counts = unique.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("loaded"),
        F.count("*").alias("deduplicated"),
        F.count_if(complete).alias("complete"),
        F.count_if(complete & _valid_order()).alias("valid"),
    )
    steps = [
        F.struct(
            F.lit(i).alias("step_no"), F.lit(step).alias("step"), F.col(step).alias("n_rows")
        )
        for i, step in enumerate(counts.columns, start=1)
    ]
    return counts.select(F.inline(F.array(*steps)))


def with_publish_instant(raw: DataFrame) -> DataFrame:
    """Bronze form: the source row plus a parsed instant, without the source's own bookkeeping."""
    return raw.withColumn("publish_ts", parse_instant("publish_time")).drop("updated_at")


def _video_casts() -> dict[str, Column]:
    return {
        "category_id": as_int("category_id"),
        **{c: as_long(c) for c in VIDEO_COUNTS},
        **{c: as_boolean(c) for c in VIDEO_FLAGS},
        "trending_date": parse_day("trending_date", TRENDING_DAY),
    }


def _newest_first(columns: list[str]) -> list[Column]:
    first = ("publish_ts", "trending_date")
    return [F.col(c).desc() for c in (*first, *[c for c in columns if c not in first])]


def clean_videos(bronze: DataFrame) -> DataFrame:
    """Cast, drop rows with any NULL (also those made by the casts), keep the newest per video."""
    typed = bronze.withColumns(_video_casts()).drop("publish_time")
    complete = typed.where(_complete(typed.columns))
    return latest_per_key(complete, ["video_id"], _newest_first(typed.columns))


#: Why a video row is rejected; the n-th reason is bit n of the mask.
VIDEO_REASONS = ("missing value", "unreadable number", "unreadable flag", "unreadable day", "older copy")


def judge_videos(bronze: DataFrame) -> DataFrame:
    """Every row of clean_videos' input, typed, with ``reasons`` (a bit mask, 0 for the rows that clean_videos keeps)
    and, for the others, ``raw``: the row as it came, as JSON.

    One pass: a row may have several reasons; only rows without another one are compared with other copies.
    """
    casts = _video_casts()
    unreadable = {c: F.col(c).isNotNull() & cast.isNull() for c, cast in casts.items()}
    some = lambda columns: reduce(lambda a, b: a | b, [unreadable[c] for c in columns])
    found = [
        ~_complete([c for c in bronze.columns if c != "publish_time"]),
        some(["category_id", *VIDEO_COUNTS]),
        some(VIDEO_FLAGS),
        some(["trending_date"]),
    ]
    mask = reduce(lambda a, b: a + b, [F.when(c, 1 << bit).otherwise(0) for bit, c in enumerate(found)])
    raw = F.to_json(F.struct(*bronze.columns))
    marked = bronze.withColumns({"reasons": mask, "raw": raw}).withColumns(casts).drop("publish_time")
    columns = [c for c in marked.columns if c not in ("reasons", "raw")]
    copies = Window.partitionBy("video_id", F.col("reasons") == 0).orderBy(*_newest_first(columns))
    older = (F.col("reasons") == 0) & (F.row_number().over(copies) > 1)
    judged = marked.withColumn("reasons", F.when(older, 1 << len(found)).otherwise(F.col("reasons")))
    return judged.withColumn("raw", F.when(F.col("reasons") != 0, F.col("raw")))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where("reasons = 0").drop("reasons", "raw")


def rejected(judged: DataFrame) -> DataFrame:
    """(reasons, raw) of the rows that are not accepted."""
    return judged.where("reasons != 0").select("reasons", "raw")


def count_reasons(judged: DataFrame) -> DataFrame:
    """(reason, n_rows) for every reason, from one aggregate; ``accepted`` has no reason. A row counts for each of its."""
    bits = [F.count_if(F.col("reasons").bitwiseAND(1 << b) != 0) for b in range(len(VIDEO_REASONS))]
    names = ["accepted", *VIDEO_REASONS]
    counts = judged.agg(*[c.alias(n) for c, n in zip([F.count_if(F.col("reasons") == 0), *bits], names, strict=True)])
    rows = [F.struct(F.lit(n).alias("reason"), F.col(f"`{n}`").alias("n_rows")) for n in names]
    return counts.select(F.inline(F.array(*rows)))
