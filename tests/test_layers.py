import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.quality import QualityError
from tallyhouse.plans.gold import DISTINCT_VIDEOS, ROLLUPS, with_month
from tallyhouse.sources.schemas import RAW_VIDEOS
from tallyhouse.sources.versions import BatchedTable, VersionedTables
from tallyhouse.streaming import layers
from tests.conftest import rows_of
from tests.test_cleaning import video


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.gold = VersionedTables(spark, f"{root}/gold")
        self.bronze, self.silver = {}, {}
        for country in ("ca", "us"):
            self.bronze[country] = BatchedTable(spark, f"{root}/bronze/{country}")
            self.silver[country] = BatchedTable(spark, f"{root}/silver/{country}")

    def source(self, rows):
        return self.spark.createDataFrame(rows, RAW_VIDEOS)

    def run(self, sources, batch_rows=3):
        for country, rows in sources.items():
            while layers.ingest(self.source(rows), self.bronze[country], batch_rows):
                pass
            layers.refine(self.bronze[country], self.silver[country])
        return layers.roll_up(self.silver, self.gold)

    def expected(self, name):
        parts = [
            t.read().withColumn("country", F.lit(c))
            for c, t in self.silver.items()
            if t.state()[0]
        ]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return ROLLUPS[name].delta(with_month(whole))

    def assert_gold_is_whole(self):
        for name in ROLLUPS:
            expected = self.expected(name)
            found = self.gold.read(name).select(*expected.columns)
            assert rows_of(found) == rows_of(expected), name


def feed(start, stop, day="2017-11-13"):
    return [
        video(f"v{i}", f"{day}T{10 + i // 3:02d}:00:00.000Z", views=str(i), channel_title=f"c{i % 2}")
        for i in range(start, stop)
    ]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def test_gold_follows_a_growing_source(lake):
    assert lake.run({"ca": feed(0, 6), "us": feed(0, 3)}) == 1
    lake.assert_gold_is_whole()
    assert lake.run({"ca": feed(0, 6), "us": feed(0, 3)}) is None
    assert lake.run({"ca": feed(0, 15)}) == 2
    lake.assert_gold_is_whole()
    assert lake.silver["ca"].read().count() == 15
    layers.check_silver(lake.silver)
    layers.check_gold(lake.gold)


def test_ties_at_the_batch_border_are_kept(lake):
    # Three rows share each hour; batches of two rows may not split them.
    lake.run({"ca": feed(0, 9)}, batch_rows=2)
    assert lake.bronze["ca"].read().count() == 9


def test_late_rows_are_dropped_for_ever(lake):
    lake.run({"ca": feed(3, 6)})
    lake.run({"ca": feed(0, 6)})
    assert lake.bronze["ca"].read().count() == 3


def test_batch_of_unreadable_rows_does_not_stop_the_pipeline(lake):
    bad = [video("x", "2017-11-13T10:00:00.000Z", views="?")]
    lake.run({"ca": bad})
    assert lake.silver["ca"].read() is None and lake.silver["ca"].state()[1] == {"bronze": 1}
    lake.run({"ca": bad + feed(3, 6)})
    assert lake.silver["ca"].read().count() == 3
    lake.assert_gold_is_whole()


def test_an_emptied_batch_does_not_block_the_gates(lake):
    bad = [video("x", "2017-11-13T10:00:00.000Z", views="?")]
    versions = []
    for rows in (bad, bad + feed(3, 6), bad + feed(3, 9)):
        versions.append(
            layers.run_pipeline({"ca": lake.source(rows)}, lake.bronze, lake.silver, lake.gold, batch_rows=10)
        )
    assert versions == [None, 1, 2]
    for number in (1, 2, 3):  # every row of a batch is in silver or among its rejects
        rows = lake.silver["ca"].batches(number, number)
        kept = rows.count() if rows is not None else 0
        assert kept + lake.silver["ca"].rejects(number, number).count() == lake.bronze["ca"].batches(number, number).count()
    assert [r.reasons for r in lake.silver["ca"].rejects(1, 3).collect()] == [2]
    assert lake.silver["ca"].read().count() == 6
    lake.assert_gold_is_whole()


def test_catch_up_reads_each_batch_by_its_range(lake):
    rows, asked = feed(0, 42) + feed(0, 42, "2017-11-14"), []
    source = lake.source(rows)

    def read(after, upto):
        asked.append((after, upto))
        return source

    assert layers.catch_up(read, lake.bronze["ca"], batch_rows=4) == 21
    assert lake.bronze["ca"].read().count() == 84
    (start, *ranges) = asked  # the plan, then each batch once
    assert start == (None, None) and len(ranges) == 21
    assert [a for a, _ in ranges] == [None, *[u for _, u in ranges[:-1]]]
    assert [lake.bronze["ca"].log.record(n)["rows"] for n in (1, 2, 21)] == [6, 3, 3]
    assert layers.catch_up(read, lake.bronze["ca"], batch_rows=4) == 0


def test_catch_up_goes_on_after_a_crash(lake, monkeypatch):
    source, commit, left = lake.source(feed(0, 30)), lake.bronze["ca"].log.commit, [2]

    def fails_third(*args):
        if not left[0]:
            raise Crash()
        left[0] -= 1
        return commit(*args)

    with monkeypatch.context() as patch:
        patch.setattr(lake.bronze["ca"].log, "commit", fails_third)
        with pytest.raises(Crash):
            layers.catch_up(source, lake.bronze["ca"], batch_rows=6)
    assert lake.bronze["ca"].read().count() == 12
    layers.catch_up(source, lake.bronze["ca"], batch_rows=6)
    assert lake.bronze["ca"].read().count() == 30 == lake.bronze["ca"].read().distinct().count()


def test_rows_without_a_time_can_be_listed(lake):
    rows = [*feed(0, 1), video("x", "soon")]
    assert [r.video_id for r in layers.unreadable(lake.source(rows)).collect()] == ["x"]
    lake.run({"ca": rows})
    assert lake.bronze["ca"].read().count() == 1


def test_same_video_in_two_batches(lake):
    again = [video("v0", "2017-11-14T10:00:00.000Z", views="5", channel_title="c0")]
    source = feed(0, 3)
    for rows in (source, source + again):
        layers.ingest(lake.source(rows), lake.bronze["ca"])
    layers.refine(lake.bronze["ca"], lake.silver["ca"])
    assert lake.silver["ca"].read().count() == 4
    layers.roll_up(lake.silver, lake.gold)
    assert lake.gold.read("overall_kpis").first().total_videos == 4
    assert rows_of(DISTINCT_VIDEOS.estimate(lake.gold.read("distinct_videos"))) == [("ca", 3)]
    layers.refine(lake.bronze["ca"], lake.silver["us"], skip_known="video_id")
    assert lake.silver["us"].read().count() == 3


class Crash(Exception):
    pass


@pytest.mark.parametrize("layer", ["bronze", "silver", "gold"])
def test_crash_between_write_and_commit(lake, monkeypatch, layer):
    lake.run({"ca": feed(0, 6)})
    log = {"bronze": lake.bronze["ca"], "silver": lake.silver["ca"], "gold": lake.gold}[layer].log
    with monkeypatch.context() as patch:
        patch.setattr(log, "commit", lambda *a: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            lake.run({"ca": feed(0, 12)})
    if layer == "gold":
        assert lake.gold.state()[0] == 1
        assert lake.gold.read("overall_kpis").first().total_videos == 6
    lake.run({"ca": feed(0, 12)})
    assert lake.silver["ca"].read().count() == 12
    lake.assert_gold_is_whole()


def test_a_commit_number_is_taken_once(lake):
    lake.run({"ca": feed(0, 3)})
    with pytest.raises(Exception, match="exist"):
        lake.gold.log.commit(1, {})


def test_gates_name_every_failed_table(lake):
    lake.run({"ca": feed(0, 3)})
    broken = lake.gold.read("overall_kpis")
    lake.gold.overwrite("overall_kpis", broken.unionByName(broken))
    lake.gold.overwrite("category_performance", lake.gold.read("category_performance").limit(0))
    with pytest.raises(QualityError, match="category_performance, overall_kpis$"):
        layers.check_gold(lake.gold)


def test_gates_skip_what_does_not_exist(lake):
    layers.check_gold(lake.gold)
    layers.check_silver(lake.silver)


def test_stream_form(lake, spark, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")

    def drain():
        stream = spark.readStream.schema(RAW_VIDEOS).parquet(landing)
        query = layers.stream_to_silver(stream, lake.silver["ca"], checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None

    lake.source(feed(3, 9)).write.parquet(landing)
    drain()
    drain()
    layers.roll_up(lake.silver, lake.gold)
    # Older than everything before, and still read: the stream follows files.
    lake.source(feed(0, 3)).write.mode("append").parquet(landing)
    drain()
    layers.roll_up(lake.silver, lake.gold)
    assert lake.silver["ca"].read().count() == 9
    lake.assert_gold_is_whole()


def test_replayed_epoch_changes_nothing(lake):
    batch = lake.source(feed(0, 3))
    for _ in range(2):
        layers._stream_step(lake.silver["ca"], "s", batch, 0)
    assert lake.silver["ca"].state()[0] == 1
    assert lake.silver["ca"].read().count() == 3


def test_a_new_stream_adds_to_a_filled_table(lake):
    lake.run({"ca": feed(0, 6)})
    table = lake.silver["ca"]
    before = table.state()[0]
    layers._stream_step(table, "s", lake.source(feed(6, 9)), 0)
    layers._stream_step(table, "other checkpoint", lake.source(feed(9, 12)), 0)
    assert table.state()[0] == before + 2 and table.read().count() == 12
    lake.run({"ca": feed(0, 6)})
    assert table.read().count() == 12
    lake.assert_gold_is_whole()


def test_a_batch_committed_during_the_rollup_waits_for_the_next(lake, monkeypatch):
    lake.run({"ca": feed(0, 3)})
    layers.ingest(lake.source(feed(0, 9)), lake.bronze["ca"], 3)
    layers.refine(lake.bronze["ca"], lake.silver["ca"])
    table, batches = lake.silver["ca"], BatchedTable.batches

    def late(self, first, last):
        found = batches(self, first, last)
        if table.state()[0] == last:
            table.commit(last + 1, table.write(last + 1, batches(table, 1, 1)), bronze=2)
        return found

    with monkeypatch.context() as patch:
        patch.setattr(BatchedTable, "batches", late)
        layers.roll_up(lake.silver, lake.gold)
    assert lake.gold.state()[1]["covered"]["ca"] == table.state()[0] - 1
    layers.roll_up(lake.silver, lake.gold)
    lake.assert_gold_is_whole()


def test_an_earlier_bad_batch_fails_the_gate(lake):
    lake.run({"ca": feed(0, 3)})
    table = lake.silver["ca"]
    bad = table.read().unionByName(table.read())
    table.commit(2, table.write(2, bad), bronze=1)
    table.commit(3, table.write(3, table.batches(1, 1)), bronze=1)
    with pytest.raises(QualityError, match="ca batch 2$"):
        layers.check_silver(lake.silver)
    layers.check_silver(lake.silver, {"ca": 2})


def test_the_second_of_two_drafts_replaces_nothing(lake, table):
    store = lake.gold
    first, second = store.draft(), store.draft()
    first.write("t", table("a int", [(1,)]))
    first.commit()
    second.write("t", table("a int", [(99,)]))
    with pytest.raises(Exception, match="exist"):
        second.commit()
    assert [r.a for r in store.read("t").collect()] == [1]
    silver = lake.silver["us"]
    mine, theirs = BatchedTable(silver.spark, silver.root), BatchedTable(silver.spark, silver.root)
    mine.commit(1, mine.write(1, table("a int", [(1,)])))
    with pytest.raises(Exception, match="exist"):
        theirs.commit(1, theirs.write(1, table("a int", [(99,)])))
    assert [r.a for r in silver.read().collect()] == [1]


def test_the_whole_chain(lake):
    published = []
    run = lambda sources: layers.run_pipeline(
        {c: lake.source(rows) for c, rows in sources.items()},
        lake.bronze, lake.silver, lake.gold, published.append, batch_rows=3,
    )
    assert run({"ca": feed(0, 6), "us": feed(0, 3)}) == 1
    assert run({"ca": feed(0, 6), "us": feed(0, 3)}) is None
    assert run({"ca": feed(0, 9), "us": feed(0, 3)}) == 2
    assert published == [lake.gold, lake.gold]
    lake.assert_gold_is_whole()
