import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.changes import merge_upsert
from tallyhouse.operators.rollup import ROW_COUNT, Rollup
from tallyhouse.sources.buckets import BUCKET, BucketedState
from tests.conftest import rows_of

ROLLUP = Rollup("r", ("k",), {"total": "v", "n": ROW_COUNT})
SCHEMA = "k string, v bigint"


def files(root):
    found = {}
    for path in Path(root, "data").rglob("*.parquet"):
        found.setdefault(int(re.search(rf"{BUCKET}=(\d+)", str(path)).group(1)), set()).add((path.name, path.stat().st_mtime_ns))
    return found


def upsert(state, delta):
    return delta if state is None else merge_upsert(state, delta, ["k"])


@pytest.fixture
def state(spark, tmp_path):
    return BucketedState(spark, str(tmp_path / "state"), ["k"], buckets=16)


def numbered(spark, first, last):
    return ROLLUP.delta(spark.createDataFrame([(f"key{i}", i) for i in range(first, last)], SCHEMA))


def test_a_small_delta_reads_and_writes_its_buckets_only(spark, state):
    assert state.read() is None
    assert state.apply(1, numbered(spark, 0, 300), ROLLUP.merge) == list(range(16))
    before, looked_at = files(state.root), []

    def merge(held, delta):
        looked_at.extend({int(re.search(rf"{BUCKET}=(\d+)", f).group(1)) for f in held.inputFiles()})
        assert "PartitionFilters: [__bucket" in held._jdf.queryExecution().executedPlan().toString()
        looked_at.append(held.count())
        return ROLLUP.merge(held, delta)

    touched = state.apply(2, numbered(spark, 7, 9), merge)
    after = files(state.root)
    assert 1 <= len(touched) <= 2 and looked_at[-1] < 100
    assert {b for b in after if after[b] != before[b]} == set(touched)
    whole = numbered(spark, 0, 300).unionByName(numbered(spark, 7, 9)).groupBy("k").agg(F.sum("total"), F.sum("n"))
    assert rows_of(state.read()) == rows_of(whole)
    assert not list(Path(state.root).glob("staged-*"))


def test_a_step_is_taken_once(spark, state):
    state.apply(1, numbered(spark, 0, 20), ROLLUP.merge)
    assert state.apply(1, numbered(spark, 0, 20), ROLLUP.merge) == []
    assert rows_of(state.read()) == rows_of(numbered(spark, 0, 20))
    assert state.apply(2, numbered(spark, 0, 0), ROLLUP.merge) == []
    with pytest.raises(ValueError, match="16 buckets"):
        BucketedState(spark, state.root, ["k"], buckets=8).read()


@pytest.mark.parametrize("died", ["before", "half", "after"])
def test_a_step_that_died_while_folders_were_replaced_is_finished(spark, state, monkeypatch, died):
    state.apply(1, numbered(spark, 0, 100), ROLLUP.merge)
    commit, settled = state.log.commit, state._settled

    def dying():
        _, record = state.log.latest()
        if "staged" not in record:
            return settled()
        staged = f"{state.root}/{record['staged']}"
        if died == "half":  # one folder replaced, the others not yet
            some = spark.read.parquet(staged).where(F.col(BUCKET) == record["touched"][0])
            some.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(state.data)
        if died == "after":  # all replaced, not recorded
            monkeypatch.setattr(state.log, "commit", lambda *a: (_ for _ in ()).throw(OSError("died")))
            settled()
        raise OSError("died")

    monkeypatch.setattr(state, "_settled", dying)
    with pytest.raises(OSError):
        state.apply(2, numbered(spark, 0, 50), ROLLUP.merge)
    monkeypatch.setattr(state, "_settled", settled)
    monkeypatch.setattr(state.log, "commit", commit)
    again = BucketedState(spark, state.root, ["k"], buckets=16)
    assert again.apply(2, numbered(spark, 0, 50), ROLLUP.merge) == []  # finished, not added again
    whole = numbered(spark, 0, 100).unionByName(numbered(spark, 0, 50)).groupBy("k").agg(F.sum("total"), F.sum("n"))
    assert rows_of(again.read()) == rows_of(whole)


def test_upserts_nulls_types_and_emptied_buckets(spark, state, table):
    rows = [(i, f"v{i}") for i in range(40)] + [(None, "x"), (None, "y")]
    old = table("k bigint, v string", rows)
    new = table("k int, v string", [(3, "new"), (100, "more"), (5, None), (None, "z")])
    state.apply(1, old, upsert)
    state.apply(2, new, upsert)
    assert rows_of(state.read()) == rows_of(merge_upsert(old, new, ["k"]))
    for i, number in enumerate([3, 4, 5]):
        gone = table("k bigint, v string", [(k, "") for k in range(200)] + [(None, "")])
        state.apply(number, gone, lambda held, delta: held.limit(0))
        assert state.read().count() == 0
    assert state.apply(6, old, upsert) and rows_of(state.read()) == rows_of(old)
