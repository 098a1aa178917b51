"""Daily rollups of a stream by event time, with a bound on how late a row may come.

State holds the days still open and the keys seen inside the bound, never the history: a day is written once,
when no row of it can be on time any more. Rows of a closed day are counted, not added.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.rollup import Rollup

KEPT_REPORTS = "spark.sql.streaming.numRecentProgressUpdates"


def on_time(rows: DataFrame, ts: str, key: Sequence[str], delay: str) -> DataFrame:
    """The first row of each key, without late rows.

    A row is late when it is older by more than ``delay`` than the newest row two or more steps before: the step
    right after still reads by the mark before. A row without a time belongs to no day and is left out. A key that
    comes back within ``delay`` is the same row; a NULL in a key is a value like any other.
    """
    known = rows.where(F.col(ts).isNotNull()).withColumn(ts, F.col(ts).cast("timestamp"))
    return known.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def daily(rows: DataFrame, ts: str, rollup: Rollup) -> DataFrame:
    """(day, keys of the rollup, its measures); a day is 24 hours of UTC. The same for a table and a stream."""
    days = rows.withColumn("day", F.window(ts, "1 day"))
    by_day = replace(rollup, keys=("day", *rollup.keys)).delta(days)
    return by_day.withColumn("day", F.col("day.start"))


def stream_days(
    landing: DataFrame, ts: str, key: Sequence[str], rollup: Rollup, delay: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Read what is new in ``landing``, append the days it closes to the Parquet table ``out``, then stop.

    The sink's own log and the checkpoint make it exact: a step that is repeated after a failure replaces its
    files, and a run without new rows writes nothing. The last days stay in the state until a later row closes them.
    """
    return (
        daily(on_time(landing, ts, key, delay), ts, rollup)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """How many rows a finished run of ``stream_days`` left out as late.

    They are counted where single rows are first compared with the watermark, before any of them are added up.
    Spark keeps the reports of a limited number of steps; a run with more of them raises instead of counting short.
    """
    reports = query.recentProgress
    kept = int(query._jsq.sparkSession().conf().get(KEPT_REPORTS))
    if len(reports) >= kept - 1:  # Spark keeps one less than the setting says
        raise ValueError(f"the run had {kept - 1} steps or more: raise {KEPT_REPORTS}")
    states = [state for report in reports for state in report["stateOperators"]]
    return sum(s["numRowsDroppedByWatermark"] for s in states if s["operatorName"] == "dedupeWithinWatermark")
