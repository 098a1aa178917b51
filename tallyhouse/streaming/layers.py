"""Source -> bronze -> silver -> gold, one committed step at a time.

* Bronze plans the bounded batches after its mark and commits each with its new mark.
* Silver cleans one bronze batch into one silver batch of the same number.
* Gold adds all silver batches it has not seen and commits the five tables together with the
  batch numbers they cover.

A step that dies before its commit leaves nothing visible and is repeated from the same input, so
rows are neither lost nor counted twice. Videos are unique within a silver batch; a video that
comes back in a later batch is a new row, and gold counts rows. Beside the five tables gold keeps a sketch
of the videos of each country, in which such a video counts once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.cleaning import accepted, clean_videos, judge_videos, rejected, with_publish_instant
from tallyhouse.operators.grouping import union_by_name
from tallyhouse.operators.lineage import saved
from tallyhouse.operators.quality import assert_all, validate, validate_all
from tallyhouse.operators.rollup import add_up
from tallyhouse.plans.gold import (
    CATEGORY_PERFORMANCE,
    CHANNEL_COUNTRY,
    CHANNEL_PERFORMANCE,
    DISTINCT_VIDEOS,
    MONTHLY_TRENDING,
    OVERALL_KPIS,
    ROLLUPS,
    gold_suites,
    silver_suite,
    with_month,
)
from tallyhouse.sources.storage import read_text
from tallyhouse.sources.versions import BatchedTable, VersionedTables
from tallyhouse.streaming.batches import between, next_batch_whole, without_timestamp
from tallyhouse.streaming.catchup import plan_batches

Reader = Callable[[int | None, int | None], DataFrame]
Source = DataFrame | Reader

BATCH_ROWS = 10_000
TS = "publish_ts"


def _as_reader(source: Source) -> Reader:
    """Rows of the bronze form after one mark, up to another. A table's time column may be computed, so a
    table is filtered after reading; a reader is given the marks and may have the source apply them."""

    def read(after: int | None, upto: int | None) -> DataFrame:
        rows = source(after, upto) if callable(source) else source
        return between(with_publish_instant(rows), TS, after, upto)

    return read


def _write(table: BatchedTable, number: int, rows: DataFrame) -> tuple[DataFrame, dict]:
    """Write a batch; what is returned beside it was counted while it was written."""
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows"), F.max(F.unix_micros(TS)).alias("mark")]
    return table.write(number, rows.observe(seen, *measures)), seen.get


def ingest(source: Source, bronze: BatchedTable, batch_rows: int = BATCH_ROWS) -> int:
    """Move the next batch of a raw video table into bronze; returns its row count."""
    done, record = bronze.state()
    mark = record.get("mark")
    batch = next_batch_whole(_as_reader(source)(mark, None), TS, mark, batch_rows)
    written, seen = _write(bronze, done + 1, batch)
    if seen["rows"]:
        bronze.commit(done + 1, written, mark=seen["mark"], rows=seen["rows"])
    return seen["rows"]


def catch_up(source: Source, bronze: BatchedTable, batch_rows: int = BATCH_ROWS) -> int:
    """Move all that is newer than the mark into bronze, batch by batch; returns the number of batches.

    The borders of all batches are planned first, so a batch reads its own range only. Each is committed
    on its own: after a failure the next run plans from the last mark on. A mark is a planned border,
    so it also holds when rows of its batch have gone from the source meanwhile.
    """
    read = _as_reader(source)
    done, record = bronze.state()
    mark, first = record.get("mark"), done
    plan = plan_batches(read(mark, None), TS, mark, batch_rows).select(F.unix_micros("upto").alias("upto"))
    for border in plan.toLocalIterator():
        done += 1
        written, seen = _write(bronze, done, read(mark, border.upto))
        bronze.commit(done, written, mark=border.upto, rows=seen["rows"])
        mark = border.upto
    return done - first


def unreadable(source: DataFrame) -> DataFrame:
    """Source rows whose publish time cannot be read; no batch will ever hold them."""
    return without_timestamp(with_publish_instant(source), TS)


def refine(
    bronze: BatchedTable,
    silver: BatchedTable,
    clean: Callable[[DataFrame], DataFrame] = clean_videos,
    skip_known: str | None = None,
    keep_rejects: bool = False,
) -> int:
    """Clean every bronze batch silver has not seen; returns the number of batches done.

    Silver's record holds the last bronze batch it covers, so its own numbers are free for other
    writers, such as a stream. ``skip_known`` names a key; rows whose key silver already holds are
    then left out, and a filter of the keys is kept with each batch, so only batches that may hold one are read. With ``keep_rejects`` a batch is judged once (by ``judge_videos``) and split into its accepted
    rows and a reject table that the same commit makes visible.
    """
    number, record = silver.state()
    done = record.get("bronze", 0)
    last, _ = bronze.state()
    for covers in range(done + 1, last + 1):
        judged = saved(judge_videos(bronze.batches(covers, covers))) if keep_rejects else None
        rows = clean(bronze.batches(covers, covers)) if judged is None else accepted(judged)
        if skip_known:
            rows = saved(rows)
            known = silver.picked(silver.holding(rows, skip_known))
            if known is not None:
                rows = rows.join(known.select(skip_known), skip_known, "left_anti")
        number += 1
        if judged is not None:
            silver.write_rejects(number, rejected(judged))
        _commit(silver, number, rows, {**_marks(record), "bronze": covers}, skip_known)
    return max(last - done, 0)


def _commit(
    silver: BatchedTable, number: int, rows: DataFrame, facts: Mapping[str, object], members: str | None = None
) -> None:
    """Commit a cleaned batch, with a filter of the key ``members``. One that cleans to nothing only moves the
    record on."""
    written, seen = _write(silver, number, rows)
    if seen["rows"]:
        if members:
            silver.write_members(number, written, members, seen["rows"])
        silver.commit(number, written, **facts)
    else:
        silver.pass_over(number, **facts)


def _marks(record: Mapping[str, object]) -> dict[str, object]:
    """What a silver record says about its sources: every new record carries it on."""
    return {k: record[k] for k in ("bronze", "streams") if k in record}


def roll_up(silver: Mapping[str, BatchedTable], gold: VersionedTables) -> int | None:
    """Add unseen silver batches of each country to gold; None when there are none."""
    covered = dict(gold.state()[1].get("covered", {}))
    fresh = []
    for country, table in silver.items():
        last, _ = table.state()  # one look: a batch committed from here on is for the next run
        seen = covered.get(country, 0)
        if last > seen:
            rows = table.batches(seen + 1, last)
            if rows is not None:
                fresh.append(rows.withColumn("country", F.lit(country)))
            covered[country] = last
    if not fresh:
        return None
    delta = with_month(union_by_name(fresh))

    draft = gold.draft()
    for rollup in (CATEGORY_PERFORMANCE, MONTHLY_TRENDING):
        merged = rollup.merge(gold.read(rollup.name), rollup.delta(delta))
        draft.write(rollup.name, merged, ["country"])
    name = CHANNEL_PERFORMANCE.name
    merged = CHANNEL_PERFORMANCE.merge(gold.read(name), CHANNEL_PERFORMANCE.delta(delta))
    channels = draft.write(name, merged, ["country"])

    # Coarser totals of the same rows come from the table just written, not from the rows.
    draft.write(
        CHANNEL_COUNTRY.name, channels.select(*CHANNEL_COUNTRY.keys, *CHANNEL_COUNTRY.measures)
    )
    kpis = channels.withColumnRenamed("video_count", "total_videos")
    draft.write(OVERALL_KPIS.name, add_up(kpis, OVERALL_KPIS.keys, list(OVERALL_KPIS.measures)))
    seen = gold.read(DISTINCT_VIDEOS.name)
    draft.write(DISTINCT_VIDEOS.name, DISTINCT_VIDEOS.merge(seen, DISTINCT_VIDEOS.delta(delta)))
    return draft.commit(covered=covered)


def check_silver(
    silver: Mapping[str, BatchedTable], after: Mapping[str, int] | None = None
) -> None:
    """Check every batch above the numbers in ``after`` (all without it), then raise once."""
    reports = []
    for name, table in silver.items():
        last, _ = table.state()
        for number in range((after or {}).get(name, 0) + 1, last + 1):
            rows = table.batches(number, number)
            if rows is not None:
                reports.append(validate(rows, silver_suite(rows.columns), f"{name} batch {number}"))
    if reports:
        assert_all(union_by_name(reports))


def check_gold(gold: VersionedTables) -> None:
    tables = {name: gold.read(name) for name in ROLLUPS}
    if any(df is not None for df in tables.values()):
        assert_all(validate_all(tables, gold_suites()))


def run_pipeline(
    sources: Mapping[str, Source],
    bronze: Mapping[str, BatchedTable],
    silver: Mapping[str, BatchedTable],
    gold: VersionedTables,
    publish: Callable[[VersionedTables], object] | None = None,
    batch_rows: int = BATCH_ROWS,
) -> int | None:
    """The whole chain: every country to bronze and silver, gate, gold, gate, publish.

    A source is a table, or a function of two marks (microseconds since 1970 or None) that reads the rows
    after one and up to the other, such as ``jdbc.ranged_reader``.
    Returns the gold version, or None if no source had anything new. What gold does not cover yet is
    checked before it is added; a failed gate stops the run, and the next run checks it again.
    """
    for country, source in sources.items():
        catch_up(source, bronze[country], batch_rows)
        refine(bronze[country], silver[country], keep_rejects=True)
    check_silver(silver, gold.state()[1].get("covered", {}))
    version = roll_up(silver, gold)
    check_gold(gold)
    if version is not None and publish is not None:
        publish(gold)
    return version


def _stream_step(silver: BatchedTable, stream: str, batch: DataFrame, epoch: int) -> None:
    """Add an epoch of a stream unless silver's records say that it has been added."""
    last, record = silver.state()
    streams = record.get("streams", {})
    if epoch > streams.get(stream, -1):
        marks = {**_marks(record), "streams": {**streams, stream: epoch}}
        _commit(silver, last + 1, clean_videos(with_publish_instant(batch)), marks)


def stream_to_silver(
    landing: DataFrame, silver: BatchedTable, checkpoint: str
) -> StreamingQuery:
    """Structured Streaming form of bronze and silver: new files in, silver batches out, then stop.

    The stream follows files instead of a mark, so late rows are kept. A replayed epoch finds itself
    recorded and does nothing; a stream with a new checkpoint is another stream, known by the id that
    Spark keeps in the checkpoint. ``roll_up`` picks the batches up like any others.
    """
    def step(batch: DataFrame, epoch: int) -> None:
        stream = json.loads(read_text(silver.spark, f"{checkpoint}/metadata"))["id"]
        _stream_step(silver, stream, batch, epoch)

    return (
        landing.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
