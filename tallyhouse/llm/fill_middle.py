r"""Fill-in-the-middle documents: prefix, suffix and middle of a text put in another order, and back.

A text is cut into lines and, by numbers drawn from its id, into prefix, middle and suffix. The parts are
moved by scattering bytes: the borders of the parts of all texts of a slice go into a difference array, its
running sum is the distance that every byte moves, and one numpy assignment writes the whole slice.
The way back finds the marks in the output, builds the same array for them and gathers the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.frames import in_arrow

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes in a mark
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)


@dataclass(frozen=True)
class Shares:
    """Out of 100: texts that are rearranged, and of these the ones that begin with the suffix."""

    seed: int = 7
    fim: int = 100
    spm: int = 50


def drawn(key: Column, shares: Shares) -> list[Column]:
    """Four unsigned numbers from the sha256 of seed and id; a null id counts as an empty one."""
    text = F.concat(F.lit(f"{shares.seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def _mark_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where <P>, <S> or <M> begins, and its letter."""
    at = np.flatnonzero(data[:-2] == ord("<")) if len(data) >= MARK else np.empty(0, np.int64)
    letter = data[at + 1]
    known = (letter == ord("P")) | (letter == ord("S")) | (letter == ord("M"))
    at = at[known & (data[at + 2] == ord(">"))]
    return at, data[at + 1]


def _unit_ends(part: tx.Slice) -> tuple[np.ndarray, np.ndarray]:
    """The ends of all lines (with their line end) of the texts, and the number of the first of each text."""
    cuts = np.flatnonzero(part.data == 10) + 1
    open_end = np.zeros(part.rows, bool)
    some = np.flatnonzero(np.diff(part.bounds) > 0)
    open_end[some] = part.data[part.bounds[some + 1] - 1] != 10
    ends = np.sort(np.concatenate([cuts, part.bounds[1:][open_end]]))
    return ends, np.searchsorted(ends, part.bounds, side="right")


def _moved(places: np.ndarray, steps: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, last, distance of each byte) for all n bytes, a slice at a time.

    places (any order, repeated ones add up) and steps are the difference array without its zeros.
    """
    order = np.argsort(places, kind="stable")
    places, steps = places[order], steps[order]
    carried = 0
    for first in range(0, n, tx.SLICE_BYTES):
        last = min(first + tx.SLICE_BYTES, n)
        low, high = np.searchsorted(places, [first, last])
        difference = np.zeros(last - first, np.int64)
        np.add.at(difference, places[low:high] - first, steps[low:high])
        difference[0] += carried
        distance = np.cumsum(difference)
        carried = int(distance[-1])
        yield first, last, distance


def _steps(starts: list[np.ndarray], targets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The difference array of parts that begin at starts[k] and go to targets[k], text after text."""
    places = np.stack(starts, axis=1).ravel()
    distance = np.stack(targets, axis=1).ravel() - places
    return places, np.diff(distance, prepend=0)


def _arrange(part: tx.Slice, draws: list[np.ndarray], shares: Shares) -> tuple[dict, np.ndarray, np.ndarray]:
    """Per text: n, form, prefix and middle; the output bytes and their bounds."""
    ends, first_unit = _unit_ends(part)
    n = np.diff(first_unit)
    length = np.diff(part.bounds)
    cut = np.sort(np.stack([draws[0] % (n + 1), draws[1] % (n + 1)]), axis=0)
    edge = np.concatenate([ends, [0]])
    at = [np.where(c > 0, edge[first_unit[:-1] + c - 1], part.bounds[:-1]) for c in cut]
    marked, _ = _mark_places(part.data)
    row_of_mark = np.searchsorted(part.bounds, marked, side="right") - 1
    row_of_mark = row_of_mark[marked + MARK <= part.bounds[row_of_mark + 1]]
    holds_mark = np.bincount(row_of_mark, minlength=part.rows) > 0
    form = np.where(draws[3] % 100 < shares.spm, SPM, PSM)
    form[(length == 0) | holds_mark | (draws[2] % 100 >= shares.fim)] = PLAIN

    plain, spm = form == PLAIN, form == SPM
    out_bounds = np.concatenate([[0], np.cumsum(length + np.where(plain, 0, 3 * MARK))])
    begin, end, out = part.bounds[:-1], part.bounds[1:], out_bounds[:-1]
    prefix, middle, suffix = at[0] - begin, at[1] - at[0], end - at[1]
    to_prefix = np.where(plain, out, out + MARK + np.where(spm, suffix + MARK, 0))
    to_suffix = np.where(plain, out + prefix + middle, out + MARK + np.where(spm, 0, prefix + MARK))
    to_middle = np.where(plain, out + prefix, out + 3 * MARK + prefix + suffix)
    scattered = np.empty(out_bounds[-1], np.uint8)
    for mark, target in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        for k, byte in enumerate(mark):
            scattered[target[~plain] - MARK + k] = byte
    for first, last, distance in _moved(*_steps([begin, at[0], at[1]], [to_prefix, to_middle, to_suffix]), len(part.data)):
        scattered[np.arange(first, last) + distance] = part.data[first:last]

    chars = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80, dtype=np.int64)])
    found = {"n": n, "form": form, "prefix_chars": chars[at[0]] - chars[begin], "middle_chars": chars[at[1]] - chars[at[0]]}
    return found, scattered, out_bounds


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    texts = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
    return texts.cast(pa.string())


def transform(docs: DataFrame, shares: Shares = Shares()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output for every row of docs.

    n counts the lines of the whole text; the prefix ends after the smaller, the middle after the larger of two
    numbers of lines drawn from the id. form is ``plain`` (output is the text, the two lengths in code points
    are null) for empty texts and those that hold a mark, else ``psm`` or ``spm``. A null text counts as empty, a
    null id as an empty one; repeated rows give equal rows; other columns are ignored; an empty table gives
    no rows. A text is moved in slices of fixed size, so memory is a few times the longest text.
    """
    names = [f"draw{k}" for k in range(4)]
    source = docs.select(F.col("doc_id"), F.col("text"), *[d.alias(c) for c, d in zip(names, drawn(F.col("doc_id"), shares), strict=True)])

    def work(batch: pa.RecordBatch) -> pa.Table:
        draws = [batch.column(c).to_numpy() for c in names]
        out = []
        for part in tx.slices(batch.column("text")):
            found, data, bounds = _arrange(part, [d[part.first : part.last] for d in draws], shares)
            plain = found["form"] == PLAIN
            out.append(
                pa.table(
                    {
                        "doc_id": batch.column("doc_id").slice(part.first, part.rows),
                        "n": pa.array(found["n"], pa.int64()),
                        "form": pa.array(FORMS).take(pa.array(found["form"])),
                        "prefix_chars": pa.array(found["prefix_chars"], pa.int64(), mask=plain),
                        "middle_chars": pa.array(found["middle_chars"], pa.int64(), mask=plain),
                        "output": _strings(data, bounds),
                    }
                )
            )
        return pa.concat_tables(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return in_arrow(source, work, schema)


def _restored(part: tx.Slice, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts behind the outputs of a slice, from their bytes and forms alone."""
    begin, end = part.bounds[:-1], part.bounds[1:]
    moved = form != PLAIN
    at, letter = _mark_places(part.data)
    row = np.searchsorted(part.bounds, at, side="right") - 1
    keep = moved[row] & (at + MARK <= part.bounds[row + 1])
    at, letter, row = at[keep], letter[keep], row[keep]
    place = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        own = letter == mark[1]
        if np.any(np.bincount(row[own], minlength=part.rows)[moved] != 1):
            raise ValueError("an output does not hold each mark once")
        place[mark] = np.zeros(part.rows, np.int64)
        place[mark][row[own]] = at[own]
    p, s, m = (place[mark] + MARK for mark in (PREFIX, SUFFIX, MIDDLE))
    spm = form == SPM
    prefix = np.where(moved, np.where(spm, place[MIDDLE], place[SUFFIX]) - p, end - begin)
    suffix = np.where(moved, np.where(spm, place[PREFIX], place[MIDDLE]) - s, 0)
    middle = np.where(moved, end - m, 0)
    bounds = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    text = bounds[:-1]
    # the other way round: parts begin in the text, and the distance leads to where they are in the output
    starts = [text, text + prefix, text + prefix + middle]
    sources = [np.where(moved, p, begin), np.where(moved, m, end), np.where(moved, s, end)]
    gathered = np.empty(bounds[-1], np.uint8)
    for first, last, distance in _moved(*_steps(starts, sources), len(gathered)):
        gathered[first:last] = part.data[np.arange(first, last) + distance]
    return gathered, bounds


def restore(outputs: DataFrame) -> DataFrame:
    """(doc_id, form, output, ...) -> the same columns and ``restored``, the text that transform() was given.

    A null output counts as empty, a null form as plain. An output whose form is psm or spm has to hold
    each mark once, as those of transform() do; others raise. A column ``restored`` is replaced; an empty
    table gives no rows.
    """
    outputs = outputs.drop("restored")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema) + ", restored string"

    def work(batch: pa.RecordBatch) -> pa.Table:
        form = np.array([FORMS.index(f or "plain") for f in batch.column("form").to_pylist()], np.int64)
        out = []
        for part in tx.slices(batch.column("output")):
            texts = _strings(*_restored(part, form[part.first : part.last]))
            out.append(pa.Table.from_batches([batch.slice(part.first, part.rows)]).append_column("restored", texts))
        return pa.concat_tables(out)

    return in_arrow(outputs, work, schema)


def digest(docs: DataFrame, shares: Shares = Shares()) -> DataFrame:
    """transform() and restore() of every row, with the sha256 of output and restored text in place of the texts."""
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return restore(transform(docs, shares)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output"), sha("restored")
    )
