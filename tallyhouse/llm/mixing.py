"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.frames import digits
from tallyhouse.llm.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5  # the mix's size as a part of all sizes
EPOCHS = 2  # a document is taken this often at most
KEY_BITS = 60
SLOT_BITS = 12  # 4096 slots of the shuffle key in each source
FINISH_SLOTS = 1 << 13  # slots for each unit of virtual time; one window sees four times as many rows


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS):
    """(no_source, source, source_size) -> the same with a column target.

    One row per source. Weights are dealt in code point order of the sources, null last, and repeat.
    A source gets level * weight words, ``epochs`` times its size at most, where the level is the
    one at which all targets add up to share * all sizes: that is what resharing the excess by weight
    comes to when no target is above its limit any more. The windows below have no partition: they
    see one row per source.
    """
    order = W.orderBy("no_source", "source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    most = (epochs * F.col("source_size")).cast("double")
    ranked = sizes.withColumn("weight", weight).withColumn("most", most)
    ranked = ranked.withColumn("fills_at", F.col("most") / F.col("weight"))
    filling = W.orderBy("fills_at", "no_source", "source")
    everything = W.partitionBy(F.lit(1))
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    rest = filling.rowsBetween(W.currentRow, W.unboundedFollowing)
    ranked = ranked.withColumn("budget", share * F.sum("source_size").over(everything))
    full_before = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = (F.col("budget") - full_before) / F.sum("weight").over(rest)
    # the level if this source and all that fill later stay below their limits
    ranked = ranked.withColumn("level", level)
    first_open = F.min(F.when(F.col("level") < F.col("fills_at"), F.col("fills_at"))).over(everything)
    level_there = F.min(
        F.when(F.col("level") < F.col("fills_at"), F.struct("fills_at", "level"))
    ).over(everything)["level"]
    target = F.when(
        first_open.isNull() | (F.col("fills_at") < first_open), F.col("most")
    ).otherwise(F.least(F.col("most"), level_there * F.col("weight")))
    return ranked.select("no_source", "source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: str = "mix:",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Documents are shuffled by a hash of doc_id. Copy e of a document has the virtual finish time
    (e * source size + words of its source up to its end) / target of the source; the copies are put
    in order of finish time over all sources and cut off where their words reach the sum of the
    targets. A copy is taken whole or not at all, so a source ends within one document of its target.

    No source is put in one task: running sums are taken inside slots of the shuffle key, on top of
    sums per slot. The cut is found from sums per slot of finish time; only the slot in which it
    falls is sorted by row.

    Null text has size 0. Sizes of 0 are never in the way and take nothing. A null source is a source
    of its own. Rows that agree in doc_id, source and size are taken together. An empty table gives
    an empty result. Columns other than doc_id, text and source are not looked at.
    """
    sized = stored(
        docs.select(
            "doc_id",
            "source",
            F.col("source").isNull().alias("no_source"),
            F.coalesce("source", F.lit("")).alias("queue"),
            word_count(F.col("text")).alias("size"),
            digits(F.col("doc_id"), seed).alias("key"),
        ).withColumn("slot", F.shiftright("key", KEY_BITS - SLOT_BITS).cast("int"))
    )
    slots = sized.groupBy("no_source", "queue", "slot").agg(F.sum("size").alias("in_slot"))
    sizes = slots.groupBy("no_source", F.col("queue").alias("source")).agg(
        F.sum("in_slot").alias("source_size")
    )
    aims = targets(sizes, weights, share, epochs).withColumnRenamed("source", "queue")
    by_source = W.partitionBy("no_source", "queue")
    earlier = by_source.orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    slots = slots.select(
        "no_source",
        "queue",
        "slot",
        F.coalesce(F.sum("in_slot").over(earlier), F.lit(0)).alias("slot_from"),
    ).join(aims, ["no_source", "queue"])
    inside = W.partitionBy("no_source", "queue", "slot").orderBy("key", "doc_id", "size")
    queued = sized.join(slots, ["no_source", "queue", "slot"]).withColumn(
        "upto", F.col("slot_from") + F.sum("size").over(inside)
    )
    finish = lambda e: (F.lit(e) * F.col("source_size") + F.col("upto")) / F.nullif(
        F.col("target"), F.lit(0.0)
    )
    place = lambda e: F.struct(
        finish(e).alias("finish"), "no_source", "queue", "key", "doc_id", "size", F.lit(e).alias("copy")
    )
    queued = stored(queued.drop("slot", "slot_from"))
    copies = queued.select(
        "size", F.explode(F.array(*[place(e) for e in range(epochs)])).alias("place")
    ).where("size > 0 and place.finish is not null")
    slot_of = F.least(F.col("place.finish") * FINISH_SLOTS, F.lit(4.0 * FINISH_SLOTS)).cast("int")
    copies = copies.withColumn("time_slot", slot_of)
    budget = aims.agg(F.sum("target")).scalar()
    passed = W.orderBy("time_slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    times = (
        copies.groupBy("time_slot").agg(F.sum("size").alias("in_slot")).withColumn("passed", F.sum("in_slot").over(passed))
    )
    cut_slot = times.where(F.col("passed") > budget).agg(F.min("time_slot")).scalar()
    before = times.where(F.col("passed") <= budget).agg(F.coalesce(F.max("passed"), F.lit(0))).scalar()
    reached = before + F.sum("size").over(W.partitionBy("time_slot").orderBy("place"))
    last_slot = copies.where(F.col("time_slot") == cut_slot).withColumn("reached", reached)
    last_place = last_slot.where(F.col("reached") <= budget).agg(F.max("place")).scalar()

    def taken(e: int) -> Column:
        slot = F.least(finish(e) * FINISH_SLOTS, F.lit(4.0 * FINISH_SLOTS)).cast("int")
        until = (slot < F.col("cut")) | (
            (slot == F.col("cut")) & F.coalesce(place(e) <= F.col("last_place"), F.lit(False))
        )
        return F.when(finish(e).isNull() | (F.col("size") == 0), 0).otherwise(
            F.coalesce(until, F.lit(True)).cast("int")
        )

    count = sum((taken(e) for e in range(1, epochs)), taken(0))
    marked = queued.withColumns({"cut": cut_slot, "last_place": last_place})
    return marked.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        count.cast("int").alias("copies"),
        (count * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, mix_of: DataFrame) -> DataFrame:
    """The rows of docs as often as the mix takes them (copies; empty texts once), all columns kept.

    mix_of is the result of mix(docs). Rows that it does not take are left out.
    """
    takes = mix_of.select(
        F.col("doc_id").alias("__id"),
        F.col("source").alias("__source"),
        F.col("size").alias("__size"),
        F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).alias("__copies"),
    ).where("__copies > 0").distinct()
    joined = docs.join(
        takes,
        docs["doc_id"].eqNullSafe(F.col("__id"))
        & docs["source"].eqNullSafe(F.col("__source"))
        & (word_count(docs["text"]) == F.col("__size")),
    )
    copies = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])
