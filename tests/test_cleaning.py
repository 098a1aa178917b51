import datetime as dt

import pytest

from tallyhouse.operators import cleaning, dedup
from tallyhouse.sources.schemas import RAW_ORDERS, RAW_VIDEOS
from tests.conftest import rows_of


@pytest.fixture
def raw_orders(spark):
    return spark.createDataFrame(
        [
            ("1", "25-07-2013", "11", " CLOSED ", "299.98"),
            ("1", "25-07-2013", "11", "closed", "299.98"),
            ("2", "25-07-2013", "12", "PENDING", "0"),
            ("x", "25-07-2013", "12", "PENDING", "5"),
            ("3", "2013-07-25", "12", "PENDING", "5"),
            ("4", "31-02-2013", "12", "PENDING", "5"),
            ("5", "25-07-2013", "12", "PENDING", None),
            ("0", "25-07-2013", "12", "PENDING", "5"),
            ("6", "25-07-2013", "12", "PENDING", "-5"),
            ("7", "25-07-2013", "0", "PENDING", "5"),
        ],
        RAW_ORDERS,
    )


def test_clean_orders(raw_orders, rows):
    day = dt.date(2013, 7, 25)
    assert rows(cleaning.clean_orders(raw_orders)) == [
        (1, 11, 299.98, day, "closed"),
        (2, 12, 0.0, day, "pending"),
    ]


def test_audit_counts_every_step(raw_orders, rows):
    assert rows(cleaning.audit_orders(raw_orders)) == [
        (1, "loaded", 10),
        (2, "deduplicated", 9),
        (3, "complete", 5),
        (4, "valid", 2),
    ]


def test_audit_of_nothing(spark, rows):
    empty = spark.createDataFrame([], RAW_ORDERS)
    assert [r[2] for r in rows(cleaning.audit_orders(empty))] == [0, 0, 0, 0]


def video(video_id, published, views="10", trending="17.14.11", **other):
    row = {
        "video_id": video_id,
        "channel_title": "ch",
        "publish_time": published,
        "trending_date": trending,
        "category_id": "1",
        "views": views,
        "likes": "2",
        "dislikes": "3",
        "comment_count": "4",
        "comments_disabled": "False",
        "ratings_disabled": "True",
        "video_error_or_removed": "False",
    }
    return tuple({**row, **other}[f.name] for f in RAW_VIDEOS.fields)


def test_clean_videos(spark):
    raw = spark.createDataFrame(
        [
            video("a", "2017-11-13T17:00:03.000Z", views="1"),
            video("a", "2017-11-13T18:00:03.000Z", views="2"),
            video("a", "2017-11-13T19:00:03.000Z", views="many"),
            video("b", "2017-11-13T17:00:03.000Z", channel_title=None),
            video("c", "2017-11-13T17:00:03.000Z", trending="2017-11-14"),
            video("d", "yesterday"),
        ],
        RAW_VIDEOS,
    )
    cleaned = cleaning.clean_videos(cleaning.with_publish_instant(raw))
    (only,) = cleaned.collect()
    assert "publish_time" not in cleaned.columns
    # A newer row that cannot be read does not displace the good one.
    assert (only.video_id, only.views, only.trending_date) == ("a", 2, dt.date(2017, 11, 14))
    assert (only.ratings_disabled, only.comments_disabled) == (True, False)


def test_source_bookkeeping_column_is_optional(spark):
    raw = spark.createDataFrame([video("a", "2017-11-13T17:00:03.000Z")], RAW_VIDEOS)
    extra = raw.withColumn("updated_at", raw.publish_time)
    assert (
        cleaning.with_publish_instant(extra).columns == cleaning.with_publish_instant(raw).columns
    )


def test_whole_row_dedup_treats_nulls_as_equal(table, rows):
    df = table("a int, b string", [(1, None), (1, None), (1, "x")])
    assert rows(dedup.distinct_rows(df)) == [(1, "x"), (1, None)]


def test_latest_per_key(table, rows):
    df = table("k int, ts int, v string", [(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "d")])
    assert rows(dedup.latest_per_key(df, ["k"], [df.ts.desc()])) == [(1, 3, "b"), (2, 1, "d")]


def test_every_row_is_accepted_or_rejected_with_its_reasons(spark):
    day = "2017-11-13T17:00:0{}.000Z"
    raw = spark.createDataFrame(
        [
            video("a", day.format(1), views="1"),
            video("a", day.format(2), views="2"),
            video("a", day.format(3), views="?"),
            video("b", day.format(1), likes=None),
            video("b", day.format(1), views="x", comments_disabled="maybe", trending="soon"),
            video("c", "soon"),
            video("d", day.format(4)),
            video("d", day.format(4)),
        ],
        RAW_VIDEOS,
    )
    bronze = cleaning.with_publish_instant(raw)
    judged = cleaning.judge_videos(bronze)
    assert rows_of(cleaning.accepted(judged)) == rows_of(cleaning.clean_videos(bronze))
    found = {(r.reasons, r.raw.count('"a"')) for r in cleaning.rejected(judged).collect()}
    assert cleaning.rejected(judged).count() + cleaning.accepted(judged).count() == 8
    assert {r for r, _ in found} == {16, 2, 1, 2 | 4 | 8}
    counted = {r.reason: r.n_rows for r in cleaning.count_reasons(judged).collect()}
    assert counted == {
        "accepted": 2, "missing value": 2, "unreadable number": 2, "unreadable flag": 1, "unreadable day": 1, "older copy": 2,
    }
    assert cleaning.count_reasons(judged.limit(0)).count() == 6
