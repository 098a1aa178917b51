"""Removing repeated passages: every byte inside a 100-byte string that also starts earlier.

A suffix array of all bytes would move each byte a hundred times, so only suffixes at anchors are kept:
in every window of LENGTH bytes the gram with the smallest hash (the leftmost of equal ones) is its anchor,
which depends on the window's bytes alone. Equal windows have equal anchors. Neighbouring windows with
one anchor make a chunk.

1. Chunks are range-partitioned by the leading bytes of the suffix at their anchor, with splitters
   taken from a sample, sorted in each bucket, and compared with their neighbours: a chunk whose bytes
   are those of an earlier one is repeated as a whole. Groups at the borders of buckets are compared across.
2. Of anchors that stand in different surroundings, one chunk of each kind is left. Their windows are
   sorted by multikey refinement, eight bytes at a time, ties only; equal ones are compared by place.
   An anchor in very many surroundings is not held in one task: its windows are grouped by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import bloom
from tallyhouse.llm import text as tx
from tallyhouse.llm.frames import in_arrow
from tallyhouse.llm.storage import stored

LENGTH = 100
GRAM = 24
SPAN = LENGTH - GRAM + 1  # grams in a window
SAMPLE = 0.02  # part of the rows from which splitters are taken
SPLITTERS = 1 << 17  # most buckets; 40 bytes each are sent to every task
BUCKET_ROWS = 500_000
MANY = 8192  # surroundings of one anchor that one task compares

_CHUNK = "lead long, gram long, around long, doc_id long, start int, n int"
_RUN = "doc_id long, start int, n int"


def _pieces(part: tx.Slice) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of bounded size: bytes, borders, row of each text, and where in its text each part begins.

    A text longer than a slice is cut into parts that overlap by LENGTH - 1 bytes, so that each window
    is in one part.
    """
    if part.rows > 1 or len(part.data) <= 2 * tx.SLICE_BYTES:
        yield part.data, part.bounds, np.arange(part.rows), np.zeros(part.rows, np.int64)
        return
    for a in range(0, len(part.data) - LENGTH + 1, tx.SLICE_BYTES):
        data = part.data[a : a + tx.SLICE_BYTES + LENGTH - 1]
        yield data, np.array([0, len(data)]), np.zeros(1, np.int64), np.array([a])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, first byte highest; zeros after the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(data)]
    return out


def _chunks(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray] | None:
    """Chunks of the windows that are new in their text, and runs of those that are not (anchor < 0)."""
    places = np.arange(max(len(data) - LENGTH + 1, 0))
    row = np.searchsorted(bounds, places, side="right") - 1
    inside = places + LENGTH <= bounds[row + 1]
    places, row = places[inside], row[inside]
    if not len(places):
        return None
    hashes = tx.Hashes(data)
    window = hashes.spans(places, places + LENGTH)
    _, first = np.unique(tx.mixed(window + tx.mixed(row.astype(np.uint64))), return_index=True)
    new = np.zeros(len(places), bool)
    new[first] = True
    at = np.arange(len(data) - GRAM + 1)
    grams = hashes.spans(at, at + GRAM)
    least = _sliding_least(grams, SPAN)[places]
    step = (np.diff(places) != 1) | (np.diff(row) != 0) | (np.diff(new.astype(np.int8)) != 0)
    cut = np.r_[True, step | (new[1:] & (least[1:] != least[:-1]))]
    begin = np.flatnonzero(cut)
    end = np.r_[begin[1:], len(places)] - 1
    a, b = places[begin], places[end]
    # the anchor: the first gram with that hash from the chunk's first window on; it is inside all of them
    offset = np.full(len(begin), -1, np.int64)
    fresh = new[begin]
    offset[fresh] = _first_equal(grams, a[fresh], least[begin][fresh])
    return {
        "row": row[begin],
        "start": a,
        "n": b - a + 1,
        "anchor": np.where(fresh, a + offset, -1),
        "gram": least[begin],
        "around": hashes.spans(a, b + LENGTH),
    }


def _first_equal(grams: np.ndarray, start: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How far after start the first gram equal to wanted stands."""
    out = np.full(len(start), -1, np.int64)
    left = np.arange(len(start))
    for k in range(SPAN):
        hit = grams[start[left] + k] == wanted[left]
        out[left[hit]] = k
        left = left[~hit]
        if not len(left):
            break
    return out


def _chunk_table(batch: pa.RecordBatch) -> pa.Table | None:
    out = []
    ids = batch.column("doc_id")
    for part in tx.slices(batch.column("text")):
        for data, bounds, rows, offsets in _pieces(part):
            c = _chunks(data, bounds)
            if c is None:
                continue
            old = c["anchor"] < 0
            lead = _eight(data)[np.maximum(c["anchor"], 0)] ^ np.uint64(1 << 63)  # signed order is byte order
            value = lambda x: pa.array(tx.signed(x), mask=old)  # noqa: E731, B023
            out.append(
                pa.table(
                    {
                        "lead": value(lead),
                        "gram": value(c["gram"]),
                        "around": value(c["around"]),
                        "doc_id": ids.take(pa.array(part.first + rows[c["row"]])),
                        "start": (c["start"] - bounds[c["row"]] + offsets[c["row"]]).astype(np.int32),
                        "n": c["n"].astype(np.int32),
                    }
                )
            )
    return pa.concat_tables(out) if out else None


def splitters(docs: DataFrame, sample: float = SAMPLE) -> tuple[np.ndarray, int]:
    """Sampled borders of the buckets (lead, gram, around, doc_id, start; sorted), and the number of buckets."""
    drawn = in_arrow(docs.sample(sample, 7), _chunk_table, _CHUNK).where("lead is not null")
    drawn = drawn.drop("n").withColumn("r", F.xxhash64("gram", "doc_id", "start"))
    total = drawn.count()
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(max(least, int(total / sample) // BUCKET_ROWS + 1), SPLITTERS)
    rows = drawn.orderBy("r").limit(8 * n).drop("r").toArrow()
    keys = np.stack(
        [rows.column(c).to_numpy().astype(np.int64) for c in ("lead", "gram", "around", "doc_id", "start")], axis=1
    ) if len(rows) else np.empty((0, 5), np.int64)
    keys = keys[np.lexsort(keys.T[::-1])]
    at = (np.arange(1, n) * len(keys)) // n
    return keys[at[at < len(keys)]] if len(keys) else keys, n


def _bucket_of(borders: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """The bucket of each row: how many borders are not above it, comparing column by column."""
    low = np.searchsorted(borders[:, 0], columns[0], side="left")
    high = np.searchsorted(borders[:, 0], columns[0], side="right")
    out = high.copy()
    for i in np.flatnonzero(low < high):  # rows whose lead is a border's: few
        own = tuple(c[i] for c in columns)
        k = low[i]
        while k < high[i] and tuple(borders[k]) <= own:
            k += 1
        out[i] = k
    return out


def _compare_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: rows with around null are runs already known to be repeated, the others chunks.

    Gives kind 1: repeated runs; kind 2: the first chunk of each surroundings of an anchor that has
    several; kind 3: the same for the bucket's first and last anchor, whatever their number.
    """
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    known = table.filter(table.column("around").is_null()).select(["doc_id", "start", "n"])
    if known.num_rows:
        nulls = pa.nulls(known.num_rows, pa.int64())
        kind = pa.array(np.ones(known.num_rows, np.int32))
        columns = [kind, nulls, nulls, *known.columns, pa.nulls(known.num_rows, pa.int32())]
        yield from pa.table(columns, _KINDS).to_batches()
    table = table.filter(table.column("around").is_valid())
    if not table.num_rows:
        return
    doc = table.column("doc_id")
    none = doc.is_null().to_numpy()
    lead, gram, around, start, n = (table.column(c).to_numpy() for c in ("lead", "gram", "around", "start", "n"))
    ids = doc.fill_null(0).to_numpy()
    order = np.lexsort((start, ids, ~none, around, gram, lead))  # no doc_id counts as smallest
    lead, gram, around, start, n, ids, none = (x[order] for x in (lead, gram, around, start, n, ids, none))
    new_anchor = np.r_[True, (lead[1:] != lead[:-1]) | (gram[1:] != gram[:-1])]
    new = new_anchor | np.r_[True, around[1:] != around[:-1]]
    anchor = np.cumsum(new_anchor) - 1
    kinds = np.bincount(anchor[new])
    edge = (anchor == 0) | (anchor == anchor[-1])
    begin = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (ids != ids[begin]) | (none != none[begin]) | (start != start[begin])  # a repeated row is not later
    kind = np.where(~new, later, np.where(edge, 3, np.where(kinds[anchor] > 1, 2, 0))).astype(np.int32)
    keep = np.flatnonzero(kind)
    columns = [
        kind[keep], gram[keep], around[keep], pa.array(ids[keep], mask=none[keep]), start[keep], n[keep],
        kinds[anchor[keep]].astype(np.int32),
    ]
    yield from pa.table([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], _KINDS).to_batches()


_KINDS = ["kind", "gram", "around", "doc_id", "start", "n", "members"]
_KIND_SCHEMA = "kind int, gram long, around long, doc_id long, start int, n int, members int"


def compared_chunks(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeated, open): runs of windows that start earlier too, and the chunks still to be compared.

    repeated: doc_id, start, n (windows). open: gram, doc_id, start, n, members (chunks of that anchor).
    """
    borders, n = splitters(docs)
    shared = docs.sparkSession.sparkContext.broadcast(borders)

    def work(batch: pa.RecordBatch) -> pa.Table | None:
        table = _chunk_table(batch)
        if table is None:
            return None
        columns = [
            table.column(c).fill_null(0).to_numpy().astype(np.int64) for c in ("lead", "gram", "around", "doc_id", "start")
        ]
        known = table.column("lead").is_null().to_numpy()
        bucket = _bucket_of(shared.value, columns) if len(shared.value) else np.zeros(table.num_rows, np.int64)
        bucket[known] = columns[4][known] % n
        return table.append_column("bucket", pa.array(bucket.astype(np.int32)))

    dealt = in_arrow(docs.select("doc_id", "text"), work, _CHUNK + ", bucket int").repartitionById(n, "bucket")
    found = stored(dealt.drop("bucket").mapInArrow(_compare_bucket, _KIND_SCHEMA))
    # across borders: the same surroundings, or other ones of the same anchor, may lie in several buckets
    edges = found.where("kind = 3")
    place = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "start")
    first = edges.groupBy("gram", "around").agg(F.min(place).alias("first"))
    kinds = first.groupBy("gram").agg(F.count(F.lit(1)).cast("int").alias("kinds"))
    edges = edges.join(first, ["gram", "around"]).join(kinds, "gram").withColumn("place", place)
    runs = found.where("kind = 1").select("doc_id", "start", "n").union(
        edges.where("place > first").select("doc_id", "start", "n")
    )
    rest = found.where("kind = 2").select("gram", "doc_id", "start", "n", "members").union(
        edges.where("place = first and kinds > 1").select("gram", "doc_id", "start", "n", "kinds")
    )
    return runs, rest


def _runs(ids: np.ndarray, none: np.ndarray, start: np.ndarray) -> pa.Table:
    """Single windows as runs."""
    order = np.lexsort((start, ids, none))
    ids, none, start = ids[order], none[order], start[order]
    same = (ids[1:] == ids[:-1]) & (none[1:] == none[:-1]) & (start[1:] - start[:-1] <= 1)
    begin = np.flatnonzero(np.r_[True, ~same]) if len(ids) else np.empty(0, np.int64)
    end = np.r_[begin[1:], len(ids)] - 1 if len(begin) else begin
    return pa.table(
        {
            "doc_id": pa.array(ids[begin], pa.int64(), mask=none[begin]),
            "start": start[begin].astype(np.int32),
            "n": (start[end] - start[begin] + 1).astype(np.int32),
        }
    )


def multikey_classes(first: np.ndarray, tokens: list[np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings that are equal in ``first`` and all tokens: (their indexes, their class), classes of two or more.

    Refinement token by token: strings of one class are sorted by the next token, and only those that
    still have an equal are looked at again.
    """
    alive = np.arange(len(at))
    key = first
    for shift in [None, *tokens]:
        if shift is not None:
            token = shift[at[alive]]
            order = np.lexsort((token, key))
            token, key, alive = token[order], key[order], alive[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (token[1:] != token[:-1])] if len(key) else np.empty(0, bool)
        else:
            order = np.argsort(key, kind="stable")
            key, alive = key[order], alive[order]
            new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, bool)
        cls = np.cumsum(new) - 1
        again = np.bincount(cls)[cls] > 1 if len(cls) else np.empty(0, bool)
        alive, key = alive[again], cls[again]
    return alive, key


def _repeated_windows(table: pa.Table) -> pa.Table:
    """Of chunks of whole anchors: the windows that are equal to an earlier one, as runs."""
    column = table.column("bytes").combine_chunks()
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    part = next(tx.slices(column, most=1 << 62))
    n = table.column("n").to_numpy()
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = part.bounds[row] + step
    eight = _eight(part.data)
    shifted = [eight[s:] for s in (*range(0, LENGTH - 8, 8), LENGTH - 8)]
    gram = table.column("gram").to_numpy()
    alive, cls = multikey_classes(gram[row], shifted, at)
    doc = table.column("doc_id")
    none = doc.is_null().to_numpy()[row[alive]]
    ids = doc.fill_null(0).to_numpy()[row[alive]]
    start = table.column("start").to_numpy()[row[alive]].astype(np.int64) + step[alive]
    order = np.lexsort((start, ids, ~none, cls))
    cls, ids, none, start = cls[order], ids[order], none[order], start[order]
    first = np.r_[True, cls[1:] != cls[:-1]] if len(cls) else np.empty(0, bool)
    group = np.cumsum(first) - 1
    where = np.flatnonzero(first)[group] if len(cls) else group
    later = (ids != ids[where]) | (none != none[where]) | (start != start[where])
    return _runs(ids[later], none[later], start[later])


def _compare_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram; whole anchors are compared as they come, a few thousand chunks at once."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < MANY:
            continue
        table = pa.Table.from_batches(held)
        gram = table.column("gram").to_numpy()
        whole = int(np.searchsorted(gram, gram[-1]))  # the last anchor may go on
        if whole:
            yield from _repeated_windows(table.slice(0, whole)).to_batches()
        held = table.slice(whole).to_batches()
        rows = table.num_rows - whole
    if rows:
        yield from _repeated_windows(pa.Table.from_batches(held)).to_batches()


def compared_windows(docs: DataFrame, rest: DataFrame) -> DataFrame:
    """The windows of the open chunks that start earlier too, as runs doc_id, start, n."""
    asked = rest.groupBy("doc_id").agg(
        F.collect_list(F.struct("gram", "start", "n", "members")).alias("asked")
    ).withColumnRenamed("doc_id", "a_doc")
    asked = stored(asked)
    near = bloom.narrowed(docs.select("doc_id", "text"), "doc_id", bloom.build(asked.select("a_doc")))
    both = near.join(asked, F.col("doc_id").eqNullSafe(F.col("a_doc"))).select("doc_id", "text", "asked")

    def cut(batch: pa.RecordBatch) -> pa.Table:
        lists = batch.column("asked")
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        gram, start, n, members = (flat.field(i).to_numpy() for i in range(4))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
        texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
        out = []
        for i in range(batch.num_rows):
            raw = texts[i].as_buffer()
            view = memoryview(raw)
            out += [bytes(view[start[j] : start[j] + n[j] + LENGTH - 1]) for j in range(first[i], first[i + 1])]
        return pa.table(
            {
                "gram": gram,
                "members": members,
                "doc_id": batch.column("doc_id").take(pa.array(owner)),
                "start": start,
                "n": n,
                "bytes": pa.array(out, pa.binary()),
            }
        )

    schema = "gram long, members int, doc_id long, start int, n int, bytes binary"
    chunks = stored(in_arrow(both, cut, schema))
    usual = chunks.where(F.col("members") <= MANY).repartition("gram").sortWithinPartitions("gram")
    runs = usual.drop("members").mapInArrow(_compare_anchors, _RUN)

    def windows(batch: pa.RecordBatch) -> pa.Table:
        column = batch.column("bytes")
        part = next(tx.slices(column, most=1 << 62))
        n = batch.column("n").to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = part.bounds[row] + step
        return pa.table(
            {
                "gram": batch.column("gram").to_numpy()[row],
                "window": tx.signed(tx.Hashes(part.data).spans(at, at + LENGTH)),
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "start": (batch.column("start").to_numpy()[row] + step).astype(np.int32),
            }
        )

    many = in_arrow(chunks.where(F.col("members") > MANY), windows, "gram long, window long, doc_id long, start int")
    place = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "start")
    first = many.groupBy("gram", "window").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    later = many.withColumn("place", place).join(first.where("times > 1"), ["gram", "window"]).where("place > first")
    return runs.union(later.select("doc_id", "start", F.lit(1).alias("n")))


def remove(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans, kept_text (binary) of the rows of docs that lose bytes.

    spans are the removed runs as (start, end) bytes. Order is that of (doc_id, start); no doc_id counts
    as smallest. Rows that share a doc_id count as one document: a run found in any is cut from all.
    Null counts as empty; texts shorter than LENGTH lose nothing; an empty table gives an empty result.
    """
    runs, rest = compared_chunks(docs)
    runs = stored(runs.union(compared_windows(docs, rest)))
    per_document = stored(
        runs.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs")).withColumnRenamed("doc_id", "r_doc")
    )
    near = bloom.narrowed(docs.select("doc_id", "text"), "doc_id", bloom.build(per_document.select("r_doc")))
    both = near.join(per_document, F.col("doc_id").eqNullSafe(F.col("r_doc"))).select("doc_id", "text", "runs")

    def cut(batch: pa.RecordBatch) -> pa.Table:
        lists = batch.column("runs")
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        start, n = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy()
        texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
        rows = []
        for i in range(batch.num_rows):
            raw = texts[i].as_py()
            a = np.minimum(start[first[i] : first[i + 1]], len(raw))
            b = np.minimum(a + n[first[i] : first[i + 1]] + LENGTH - 1, len(raw))
            order = np.argsort(a, kind="stable")
            a, reach = a[order], np.maximum.accumulate(b[order])
            new = np.flatnonzero(np.r_[True, a[1:] > reach[:-1]])
            begin, end = a[new], np.r_[reach[new[1:] - 1], reach[-1]]
            some = end > begin
            begin, end = begin[some], end[some]
            inner = zip(np.r_[0, end], np.r_[begin, len(raw)], strict=True)
            rows.append((len(raw), begin, end, b"".join(raw[x:y] for x, y in inner)))
        spans = [list(map(list, zip(r[1].tolist(), r[2].tolist(), strict=True))) for r in rows]
        return pa.table(
            {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([r[0] for r in rows], pa.int64()),
                "n_removed": pa.array([int((r[2] - r[1]).sum()) for r in rows], pa.int64()),
                "n_spans": pa.array([len(r[1]) for r in rows], pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                "kept_text": pa.array([r[3] for r in rows], pa.binary()),
            }
        )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept_text binary"
    return in_arrow(both, cut, schema)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs."""
    cut = remove(docs).select(
        F.col("doc_id").alias("c_doc"), F.col("n_bytes").alias("c_bytes"), "n_removed", "n_spans",
        F.sha2("kept_text", 256).alias("cut_sha256"),
    ).distinct()
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("sha256"))
    joined = rows.join(cut, F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("n_bytes") == F.col("c_bytes")), "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("cut_sha256", "sha256").alias("kept_sha256"),
    )
