"""Document quality: logistic regression over hashed word n-grams, trained with FTRL-proximal."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.frames import held_out, in_arrow

SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
MAX_DOCS = 16_000  # labelled rows the model is fitted on at most, the first by a hash of doc_id
EPOCHS = 3
LEAST_UPDATES = 12_000  # small samples are gone through more often
THRESHOLD = 0.7
HELD_OUT = (4, 2)  # crc32(doc_id) modulo 4 is 2


@dataclass(frozen=True)
class Ftrl:
    """Learning rate, its smoothing, and the two penalties."""

    alpha: float = 1.0
    beta: float = 0.5
    l1: float = 0.01
    l2: float = 0.01


def features(part: tx.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct slots of the words and word pairs of each text, their values, and where each text begins.

    All pairs of one word with itself share a slot, so repetition is seen whatever the word. A value
    is 1 + log(count), over the length of the text's vector of values.
    """
    w = tx.words(part.data, part.bounds, tx.SPACED)
    h = tx.Hashes(part.data).spans(w.starts, w.ends)
    at, pairs = tx.runs_of(h, w, 2)
    pairs[h[at] == h[at + 1]] = 0
    rows = np.concatenate([w.rows, w.rows[at]])
    slots = (np.concatenate([h, pairs]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    key, n = np.unique((rows << SLOT_BITS) | slots, return_counts=True)
    value = 1 + np.log(n)
    row = key >> SLOT_BITS
    length = np.sqrt(np.bincount(row, value * value, part.rows))
    return key & (SLOTS - 1), value / length[row], np.searchsorted(row, np.arange(part.rows + 1))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], ftrl: Ftrl = Ftrl(), epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the slots; the last place is the bias. One pass after the other, row by row: ``epochs``
    times, and LEAST_UPDATES updates at least.

    The bias is the log-odds of the labels, which is what a text without any known word gets.
    """
    z, n = np.zeros(SLOTS), np.zeros(SLOTS)
    ones = sum(label for _, _, label in examples)
    bias = np.log((ones + 1) / (len(examples) - ones + 1))

    def weights(at) -> np.ndarray:
        rate = (ftrl.beta + np.sqrt(n[at])) / ftrl.alpha + ftrl.l2
        return np.where(np.abs(z[at]) <= ftrl.l1, 0.0, (np.sign(z[at]) * ftrl.l1 - z[at]) / rate)

    for _ in range(max(epochs, LEAST_UPDATES // max(len(examples), 1))):
        for at, x, label in examples:
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x + bias, -35, 35))) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ftrl.alpha * w
            n[at] += g * g
    return np.append(weights(slice(None)), bias).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> np.ndarray:
    """Fit on the labelled rows that are not held out, max_docs at most.

    Tasks turn texts into slots; one task runs the updates, which are sequential, over the bounded sample.
    Null labels are left out; of repeated labels of a document the largest counts. Without any labelled
    row all weights are 0.
    """
    known = labels.where(F.col("label").isNotNull() & ~held_out(F.col("doc_id"), *HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)

    def work(batch: pa.RecordBatch) -> pa.Table:
        out = []
        for part in tx.slices(batch.column("text")):
            slots, values, first = features(part)
            rows = batch.slice(part.first, part.rows)
            first = pa.array(first, pa.int32())
            out.append(
                pa.table(
                    {
                        "doc_id": rows.column("doc_id"),
                        "label": rows.column("label"),
                        "slots": pa.ListArray.from_arrays(first, pa.array(slots, pa.int32())),
                        "x": pa.ListArray.from_arrays(first, pa.array(values, pa.float32())),
                    }
                )
            )
        return pa.concat_tables(out)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            lists, values = batch.column("slots"), batch.column("x").values.to_numpy()
            first, slots = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i, y in enumerate(batch.column("label").to_pylist()):
                own = slice(first[i], first[i + 1])
                examples.append((slots[own], values[own], y))
        yield pa.RecordBatch.from_pydict({"weights": [train(examples).tobytes()]})

    # max_docs pairs of numbers are broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    slots = in_arrow(rows, work, "doc_id long, label int, slots array<int>, x array<float>")
    slots = slots.orderBy(F.xxhash64("doc_id"), "doc_id", "slots").limit(max_docs)
    found = slots.mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(found[0]["weights"], np.float32) if found else np.zeros(SLOTS + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score for every row of docs: the probability that the label is 1.

    A score is the sparse dot product of the weights with the text's values, plus the bias. Null and
    empty texts have no slots and get the score of the bias. Every whole text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def work(batch: pa.RecordBatch) -> pa.Table:
        w, out = shared.value, []
        for part in tx.slices(batch.column("text")):
            slots, values, first = features(part)
            rows = np.repeat(np.arange(part.rows), np.diff(first))
            total = np.bincount(rows, w[slots] * values, part.rows) + float(w[-1])
            p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            out.append(pa.table({"doc_id": batch.column("doc_id").slice(part.first, part.rows), "score": p}))
        return pa.concat_tables(out)

    return in_arrow(docs.select("doc_id", "text"), work, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs; labels has doc_id and label."""
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
