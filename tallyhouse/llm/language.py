"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.frames import held_out, in_arrow

SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
AT_ONCE = 1 << 23  # log-probabilities gathered at a time in a task, four bytes each
UNKNOWN = "und"
HELD_OUT = (4, 2)  # crc32(doc_id) modulo 4 is 2

_tables: dict[str, np.ndarray] = {}


def _fold() -> np.ndarray:
    """Code point -> its lower case if it is a letter, a blank otherwise."""
    if "fold" not in _tables:
        table = np.full(0x110000, 32, np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _tables["fold"] = table
    return _tables["fold"]


def _characters(part: tx.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of a slice and where each text begins."""
    raw = part.data.tobytes()
    try:
        cps = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        chars = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
        first = chars[part.bounds]
    except UnicodeDecodeError:
        texts = [part.text(i).decode("utf-8", "replace") for i in range(part.rows)]
        cps = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return _fold()[cps], first


def _grams(chars: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the slot of the n-gram at each place, and where it crosses a text's end."""
    code = np.zeros(len(chars), np.uint32)
    bad = np.zeros(len(chars), bool)
    for n in range(1, max(ORDERS) + 1):
        shifted = np.zeros_like(chars)
        if n <= len(chars):
            shifted[: len(chars) - n + 1] = chars[n - 1 :]
        code = (code ^ shifted) * np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        if n > 1:
            ends = first[1:][np.diff(first) >= n - 1] - (n - 1)
            bad[ends] = True
        if n in ORDERS:
            slot = (code * np.uint32(0x85EBCA6B) + np.uint32(n)) >> np.uint32(32 - SLOT_BITS)
            yield slot, bad


@dataclass(frozen=True)
class Model:
    """Languages, and for each slot and language the logarithm of its probability."""

    languages: list[str]
    log_slots: np.ndarray
    log_prior: np.ndarray


def counts(docs: DataFrame) -> DataFrame:
    """(text, lang) -> lang, slot, n: n-gram counts per language. Slot -1 counts the documents.

    Every task adds up its rows first, so a language that holds most rows costs no more than any other.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part in tx.slices(batch.column("text")):
                chars, first = _characters(part)
                own = langs[part.first : part.last]
                names = sorted(set(own))
                index = np.array([names.index(x) for x in own])
                of_char = np.repeat(index, np.diff(first))
                found = np.zeros((len(names), SLOTS + 1), np.int64)
                found[:, SLOTS] = np.bincount(index, minlength=len(names))
                for slot, bad in _grams(chars, first):
                    good = ~bad
                    flat = of_char[good] * SLOTS + slot[good]
                    found[:, :SLOTS] += np.bincount(flat, minlength=len(names) * SLOTS).reshape(len(names), SLOTS)
                for i, name in enumerate(names):
                    total[name] = total.get(name, 0) + found[i]
        for name, n in total.items():
            at = np.flatnonzero(n)
            slots = np.where(at == SLOTS, -1, at).astype(np.int32)
            yield from pa.table({"lang": pa.array([name] * len(at)), "slot": slots, "n": n[at]}).to_batches()

    return docs.select("text", "lang").mapInArrow(over, "lang string, slot int, n long").groupBy(
        "lang", "slot"
    ).agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, training: Column | None = None) -> Model:
    """Learn from the rows of docs with a non-null lang (and where training holds).

    All such rows are counted. The driver gets one packed row of SLOTS + 1 counts per language.
    """
    rows = docs.where(F.col("lang").isNotNull())
    rows = rows if training is None else rows.where(training)

    def pack(group):
        import pandas as pd

        n = np.zeros(SLOTS + 1, np.int64)
        n[group["slot"].to_numpy()] = group["n"].to_numpy()  # slot -1 is the last place
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "n": [n.tobytes()]})

    packed = counts(rows).groupBy("lang").applyInPandas(pack, "lang string, n binary").collect()
    packed = sorted(packed, key=lambda r: r["lang"])
    table = np.array([np.frombuffer(r["n"], np.int64) for r in packed], float).reshape(-1, SLOTS + 1)
    slots, documents = table[:, :SLOTS] + SMOOTHING, table[:, SLOTS]
    log_slots = np.log(slots / slots.sum(axis=1, keepdims=True)).T
    return Model(
        [r["lang"] for r in packed],
        np.ascontiguousarray(log_slots, np.float32),
        np.log(documents / max(documents.sum(), 1)),
    )


def _add_logs(
    total: np.ndarray, log_slots: np.ndarray, slot: np.ndarray, bad: np.ndarray, starts: np.ndarray, rows: np.ndarray
) -> None:
    """Add to total the logs of each row's grams, for so many characters at a time that AT_ONCE numbers are held.

    rows begin at starts and fill all characters; a row may reach over several pieces.
    """
    step = max(1, AT_ONCE // log_slots.shape[1])
    for begin in range(0, len(slot), step):
        end = min(begin + step, len(slot))
        each = log_slots[slot[begin:end]]
        each[bad[begin:end]] = 0
        low, high = np.searchsorted(starts, begin, "right") - 1, np.searchsorted(starts, end)
        inside = np.maximum(starts[low:high], begin) - begin
        total[rows[low:high]] += np.add.reduceat(each, inside, axis=0, dtype=np.float64)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (the posterior of lang_pred) for every row of docs.

    Null texts, texts without a letter, and all texts if no language was learned: UNKNOWN, score 0.
    Ties go to the first language by code point. Every whole text is read; repeated rows are scored each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.Table:
        m, out = shared.value, []
        for part in tx.slices(batch.column("text")):
            chars, first = _characters(part)
            filled = np.flatnonzero(np.diff(first))
            total = np.tile(m.log_prior, (part.rows, 1))
            for slot, bad in _grams(chars, first):
                if not len(filled) or not m.languages:
                    break
                _add_logs(total, m.log_slots, slot, bad, first[:-1][filled], filled)
            letters = tx.sums_by_row((chars != 32).astype(np.int64), first)
            known = (letters > 0) & bool(m.languages)
            if m.languages:
                best = total.argmax(axis=1)
                p = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                names = np.array(m.languages, object)[best]
            else:
                p, names = np.zeros(part.rows), np.full(part.rows, UNKNOWN, object)
            out.append(
                pa.table(
                    {
                        "doc_id": batch.column("doc_id").slice(part.first, part.rows),
                        "lang_pred": pa.array(np.where(known, names, UNKNOWN), pa.string()),
                        "score": pa.array(np.where(known, p, 0.0)),
                    }
                )
            )
        return pa.concat_tables(out)

    return in_arrow(docs.select("doc_id", "text"), work, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """score() with a model learned from the rows of docs that are not held out, and the mark held_out."""
    mark = held_out(F.col("doc_id"), *HELD_OUT)
    return score(docs, fit(docs, ~mark)).select("doc_id", mark.alias("held_out"), "lang_pred", "score")
