"""The five video rollups and their quality suites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.quality import MinRows, NotNull, Rule, Unique, key_rules
from tallyhouse.operators.rollup import ROW_COUNT, DistinctCount, Rollup

CHANNEL_PERFORMANCE = Rollup(
    "channel_performance",
    ("channel_title", "country"),
    {
        "total_views": "views",
        "total_likes": "likes",
        "total_dislikes": "dislikes",
        "total_comments": "comment_count",
        "video_count": ROW_COUNT,
    },
)

CATEGORY_PERFORMANCE = Rollup(
    "category_performance",
    ("category_id", "country"),
    {"total_views": "views", "video_count": ROW_COUNT},
)

MONTHLY_TRENDING = Rollup(
    "monthly_trending",
    ("year", "month", "country"),
    {"total_views": "views", "video_count": ROW_COUNT},
)

OVERALL_KPIS = Rollup(
    "overall_kpis",
    ("country",),
    {
        "total_views": "views",
        "total_likes": "likes",
        "total_comments": "comment_count",
        "total_videos": ROW_COUNT,
    },
)

CHANNEL_COUNTRY = Rollup("channel_country", ("channel_title", "country"), {"total_views": "views"})

ROLLUPS = {
    r.name: r
    for r in (
        CHANNEL_PERFORMANCE,
        CATEGORY_PERFORMANCE,
        MONTHLY_TRENDING,
        OVERALL_KPIS,
        CHANNEL_COUNTRY,
    )
}


#: Videos, not rows: a video that comes back in a later batch counts once.
DISTINCT_VIDEOS = DistinctCount("distinct_videos", ("country",), "video_id")


def with_month(rows: DataFrame) -> DataFrame:
    """The calendar parts the monthly rollup groups by."""
    return rows.withColumns({"year": F.year("trending_date"), "month": F.month("trending_date")})


def gold_suites() -> dict[str, list[Rule]]:
    """Each table has rows and a complete, unique key."""
    return {name: [MinRows(1), *key_rules(*r.keys)] for name, r in ROLLUPS.items()}


def silver_suite(columns: list[str], key: str = "video_id") -> list[Rule]:
    """What cleaning promises: rows, no NULL anywhere, one row per video."""
    return [MinRows(1), *[NotNull(c) for c in columns], Unique((key,))]
