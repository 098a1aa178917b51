import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.membership import blocks_for, filter_of, matches, may_hold
from tallyhouse.sources.versions import BatchedTable
from tallyhouse.streaming import layers
from tests.test_layers import Lake, feed


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def _keys(spark, prefix, n):
    return spark.range(n).select(F.concat(F.lit(prefix), "id").alias("key"))


def test_every_key_is_found_and_others_seldom(spark):
    stored, blocks = _keys(spark, "v", 20_000), blocks_for(20_000)
    filters = filter_of(stored, "key", 7, blocks)
    assert blocks == 2048 and filters.count() <= blocks
    assert matches(filters, stored, "key", blocks).count() == 20_000
    assert matches(filters, _keys(spark, "w", 20_000), "key", blocks).count() <= 2


def test_a_full_filter_errs_on_one_key_in_10_000(spark):
    blocks = blocks_for(2**14)
    filters = filter_of(_keys(spark, "v", 2**14), "key", 1, blocks)
    assert blocks * 16 == 2**14  # no filter is fuller
    assert matches(filters, _keys(spark, "w", 200_000), "key", blocks).count() <= 20


def test_null_and_repeated_keys_and_empty_sets(table):
    stored = table("key string", [("a",), ("a",), (None,), ("",)])
    filters = filter_of(stored, "key", 3, 1)
    assert [r.batch for r in may_hold(filters, table("key string", [("a",), ("a",)]), "key", 1).collect()] == [3]
    assert may_hold(filters, table("key string", [("",)]), "key", 1).count() == 1
    assert may_hold(filters, table("key string", [(None,)]), "key", 1).count() == 0
    assert may_hold(filters, stored.limit(0), "key", 1).count() == 0
    assert filter_of(table("key string", [(None,)]), "key", 3, 1).count() == 0


def test_blocks_follow_the_size_of_the_set():
    assert [blocks_for(n) for n in (0, 1, 16, 17, 32, 33, 10_000)] == [1, 1, 1, 2, 2, 4, 1024]


def test_only_batches_that_may_hold_a_key_are_read(lake, monkeypatch):
    """Nine batches of three videos; then one batch brings back v4 and one new video."""
    bronze, silver = lake.bronze["ca"], lake.silver["ca"]
    layers.catch_up(lake.source(feed(0, 27)), bronze, batch_rows=3)
    picked, read = [], BatchedTable.picked

    def picking(self, numbers):
        if self is silver:
            picked.append(list(numbers))
        return read(self, numbers)

    with monkeypatch.context() as patch:
        patch.setattr(BatchedTable, "picked", picking)
        layers.refine(bronze, silver, skip_known="video_id")
        assert picked == [[]] * 9  # history is not read for keys it does not hold
        again = feed(4, 5, "2017-11-14") + feed(40, 41, "2017-11-14")
        layers.catch_up(lake.source(again), bronze)
        layers.refine(bronze, silver, skip_known="video_id")
        assert {n for numbers in picked for n in numbers} == {2}
    assert sorted(r.video_id for r in silver.read().collect()) == sorted([*[f"v{i}" for i in range(27)], "v40"])
    everything = silver.read().select("video_id")
    assert everything.distinct().count() == everything.count() == 28


def test_batches_without_a_filter_are_always_read(lake):
    bronze, silver = lake.bronze["ca"], lake.silver["ca"]
    layers.catch_up(lake.source(feed(0, 6)), bronze, batch_rows=3)
    layers.refine(bronze, silver)
    none_known = lake.source(feed(50, 51)).select("video_id")
    assert silver.holding(none_known, "video_id") == [1, 2]
    layers.catch_up(lake.source(feed(3, 5, "2017-11-14") + feed(30, 31, "2017-11-14")), bronze)
    layers.refine(bronze, silver, skip_known="video_id")
    assert [r.video_id for r in silver.batches(3, 3).collect()] == ["v30"]
    assert silver.holding(none_known, "video_id") == [1, 2]
    assert silver.holding(none_known, "title") == [1, 2, 3]
