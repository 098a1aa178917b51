"""Links between documents whose sets of word n-grams overlap, and the components they form.

Documents with the same set are one class, held by its smallest doc_id. A class is indexed under the
rarest part of its set that any partner must share a gram with (the prefix filter); rarity comes from a
table of counts of fixed size. Work is then saved by relations between sets:

* pairs whose indexed parts already show too many differences are not looked at further;
* lists are cut into blocks of like size, and blocks whose sizes cannot match are skipped;
* in each block all members are compared with one pivot first. What links to the pivot is one component,
  and pairs inside a component are not compared any more;
* what is left in long lists is compared block against block, where a set's overlaps with a block are
  derived from those of the set before it: only the grams in which the two differ are looked up.

No list is cut off: every pair that shares an indexed gram is either compared or already connected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import bloom
from tallyhouse.llm import text as tx
from tallyhouse.llm.components import components
from tallyhouse.llm.frames import in_arrow
from tallyhouse.llm.storage import stored

FREQUENCY_BITS = 20  # the table of counts has 2**20 places, 2 MB
RARITY_BITS = 14  # counts above 2**14 - 1 are told apart no more
PACKED = 1 << 12  # places in a row of the packed table
LONG_LIST = 64  # lists with more classes are compared in blocks
BLOCK = 1024  # sets in a block


@dataclass(frozen=True)
class Grams:
    """n words a gram; a link needs percent * union <= 100 * intersection."""

    n: int = 3
    percent: int = 90

    def prefix(self, size: np.ndarray) -> np.ndarray:
        """A partner shares a gram with the first so many of a set of this size, in any common order."""
        return size - (size * self.percent + 99) // 100 + 1

    def linked(self, common, a, b):
        return (100 * common >= self.percent * (a + b - common)) & (common > 0)

    def size_block(self, size: Column) -> Column:
        """Sets whose blocks are two or more apart differ too much in size to be linked."""
        width = math.log(100 / self.percent) * (1 + 1e-9)
        return F.floor(F.log(size) / F.lit(width)).cast("int")


def gram_sets(data: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram hash), sorted by row and hash, each once. A text of 1 to n - 1 words has one gram."""
    data = tx.LOWER[data]
    w = tx.words(data, bounds, tx.SPACED)
    h = tx.span_hashes(data, w.starts, w.ends)
    at, grams = tx.runs_of(h, w, n)
    rows = [w.rows[at]]
    hashes = [grams]
    for k in range(1, n):
        short = np.flatnonzero(w.counts == k)
        one = tx.Spans(w.starts, w.ends, w.first)
        at, whole = tx.runs_of(h, one, k)
        begin = np.searchsorted(at, w.first[short])
        rows.append(short)
        hashes.append(whole[begin])
    row, gram = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    return row[new], gram[new]


def frequencies(docs: DataFrame, grams: Grams) -> np.ndarray:
    """How many sets hold the grams of each place of a table of fixed size, places given by the hash."""
    size = 1 << FREQUENCY_BITS

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in tx.slices(batch.column("text")):
                _, gram = gram_sets(part.data, part.bounds, grams.n)
                total += np.bincount((gram >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64), minlength=size)
        at = np.flatnonzero(total)
        yield from pa.table({"place": at.astype(np.int32), "n": total[at]}).to_batches()

    counts = docs.select("text").mapInArrow(over, "place int, n long").groupBy("place").agg(
        F.least(F.sum("n"), F.lit((1 << RARITY_BITS) - 1)).cast("short").alias("n")
    )

    def pack(rows):
        import pandas as pd

        block = np.zeros(PACKED, np.int16)
        block[rows["place"].to_numpy() % PACKED] = rows["n"].to_numpy()
        return pd.DataFrame({"block": [rows["place"].iloc[0] // PACKED], "n": [block.tobytes()]})

    # the driver gets the table in a few hundred rows of two bytes a place
    packed = counts.groupBy((F.col("place") / PACKED).cast("int")).applyInPandas(pack, "block int, n binary")
    table = np.zeros(size, np.int16)
    for row in packed.collect():
        table[row["block"] * PACKED : (row["block"] + 1) * PACKED] = np.frombuffer(row["n"], np.int16)
    return table


def signatures(docs: DataFrame, grams: Grams) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (a 128-bit hash of the set), prefix (its rarest grams, in order).

    A gram of the prefix is a number: its place in the common order, rarity first, then hash. Two grams that
    share a number make a candidate more and a bound weaker, never a link less.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequencies(docs, grams))

    def work(batch: pa.RecordBatch) -> pa.Table:
        out = []
        for part in tx.slices(batch.column("text")):
            row, gram = gram_sets(part.data, part.bounds, grams.n)
            first = np.searchsorted(row, np.arange(part.rows + 1))
            size = np.diff(first)
            both = [tx.sums_by_row(tx.mixed(gram + np.uint64(salt)), first) for salt in (1, 2)]
            rare = table.value[(gram >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)]
            number = (rare.astype(np.int64) << (63 - RARITY_BITS)) | (tx.mixed(gram) >> np.uint64(1 + RARITY_BITS)).astype(np.int64)
            number = number[np.lexsort((number, row))]  # rows stay where they are
            rank = np.arange(len(row)) - first[row]
            keep = rank < grams.prefix(size)[row]
            start = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=part.rows))])
            out.append(
                pa.table(
                    {
                        "doc_id": batch.column("doc_id").slice(part.first, part.rows),
                        "n_shingles": pa.array(size, pa.int64()),
                        "set_a": tx.signed(both[0]),
                        "set_b": tx.signed(both[1]),
                        "prefix": pa.ListArray.from_arrays(
                            pa.array(start, pa.int32()), pa.array(number[keep])
                        ),
                    }
                )
            )
        return pa.concat_tables(out)

    schema = "doc_id long, n_shingles long, set_a long, set_b long, prefix array<long>"
    return in_arrow(docs.select("doc_id", "text"), work, schema)


def _row_slices(batch: pa.RecordBatch, columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text in the given columns."""
    import pyarrow.compute as pc

    sizes = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy().astype(np.int64) for c in columns)
    group = np.cumsum(sizes) // tx.SLICE_BYTES
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


def _sets_of(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    part = next(tx.slices(column, most=1 << 62))
    return gram_sets(part.data, part.bounds, n)


def possible(pairs: DataFrame, classes: DataFrame, grams: Grams) -> DataFrame:
    """The pairs (a, b) that their prefixes do not rule out.

    Up to the earlier of the two prefixes' last grams, all grams of both sets are known; beyond it, the sets
    share no more than the smaller rest. If even that makes no link, the texts need not be fetched.
    """
    sides = [
        classes.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("prefix").alias(f"p_{c}"))
        for c in "ab"
    ]
    both = pairs.join(sides[1], "b").join(sides[0], "a")
    last = F.least(F.element_at("p_a", -1), F.element_at("p_b", -1))
    rest = [F.col(f"n_{c}") - F.size(F.filter(f"p_{c}", lambda g: g <= F.col("last"))) for c in "ab"]
    most = F.size(F.array_intersect("p_a", "p_b")) + F.least(*rest)
    both = both.withColumn("last", last).withColumn("most", most)
    return both.where(100 * F.col("most") >= grams.percent * (F.col("n_a") + F.col("n_b") - F.col("most"))).select(
        "a", "b"
    ).distinct()


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, text of the rows of docs whose doc_id is among ids (one column)."""
    wanted = stored(ids.select(F.col(ids.columns[0]).alias("wanted")).distinct())
    near = bloom.narrowed(docs.select("doc_id", "text"), "doc_id", bloom.build(wanted))
    return near.join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi")


def compare(pairs: DataFrame, docs: DataFrame, classes: DataFrame, grams: Grams) -> DataFrame:
    """The pairs (a, b) that their prefixes do not rule out and whose texts are linked."""
    return confirmed(stored(possible(pairs, classes, grams)), docs, grams)


def confirmed(pairs: DataFrame, docs: DataFrame, grams: Grams) -> DataFrame:
    """The pairs (a, b) whose texts are linked. A text is looked up once for each side of each pair."""
    texts = stored(texts_of(docs, pairs.select("a").union(pairs.select("b"))))
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")

    def work(batch: pa.RecordBatch) -> pa.Table:
        out = []
        for rows in _row_slices(batch, ("text_a", "text_b")):
            row_a, gram_a = _sets_of(rows.column("text_a"), grams.n)
            row_b, gram_b = _sets_of(rows.column("text_b"), grams.n)
            row, gram = np.concatenate([row_a, row_b]), np.concatenate([gram_a, gram_b])
            order = np.lexsort((gram, row))
            row, gram = row[order], gram[order]
            twice = np.flatnonzero((row[1:] == row[:-1]) & (gram[1:] == gram[:-1]))
            count = lambda r: np.bincount(r, minlength=rows.num_rows)
            hit = grams.linked(count(row[twice]), count(row_a), count(row_b))
            out.append(pa.table({c: rows.column(c).filter(pa.array(hit)) for c in ("a", "b")}))
        return pa.concat_tables(out)

    return in_arrow(both, work, "a long, b long")


def _overlaps(own: list[np.ndarray], other: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each set of ``own``: its index and the sizes of its intersections with all sets of ``other``.

    Sets are taken in an order that puts like sets together; the answers of one are those of the one
    before, less the lists of the grams that only that one has, plus those of the grams that are new.
    """
    gram = np.concatenate(other)
    holder = np.repeat(np.arange(len(other)), [len(s) for s in other])
    order = np.argsort(gram, kind="stable")
    gram, holder = gram[order], holder[order]

    def counted(grams: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(gram, grams), np.searchsorted(gram, grams, side="right")
        n = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(holder[at], minlength=len(other))

    answers, last = np.zeros(len(other), np.int64), np.empty(0, np.uint64)
    for i in sorted(range(len(own)), key=lambda i: own[i][:8].tolist()):
        new, gone = np.setdiff1d(own[i], last, True), np.setdiff1d(last, own[i], True)
        if len(new) + len(gone) < len(own[i]):
            answers = answers + counted(new) - counted(gone)
        else:
            answers = counted(own[i])
        last = own[i]
        yield i, answers


def _compare_blocks(blocks: DataFrame, grams: Grams) -> DataFrame:
    """(pair, side, doc_id, label, text), one group for each pair of blocks -> links a, b.

    Only links between labels that are not yet connected inside the pair are given: with them, all
    members of linked labels are connected.
    """
    import pandas as pd

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "doc_id", "text"]).reset_index(drop=True)
        row, gram = _sets_of(pa.array(rows["text"], pa.string()), grams.n)
        first = np.searchsorted(row, np.arange(len(rows) + 1))
        sets = [gram[first[i] : first[i + 1]] for i in range(len(rows))]
        size = np.diff(first)
        left = np.flatnonzero((rows["side"] != 1).to_numpy())  # side 2 is compared with itself
        right = np.flatnonzero((rows["side"] != 0).to_numpy())
        ids = rows["doc_id"].to_numpy()
        _, label = np.unique(rows["label"].to_numpy(), return_inverse=True)
        root = np.arange(label.max() + 1)
        out = []
        if len(left) and len(right):
            for i, common in _overlaps([sets[x] for x in left], [sets[x] for x in right]):
                x = left[i]
                own = root[label[x]]
                hit = np.flatnonzero(grams.linked(common, size[x], size[right]) & (root[label[right]] != own))
                theirs, at = np.unique(root[label[right[hit]]], return_index=True)
                out += [(ids[x], ids[right[hit[j]]]) for j in at]
                root[np.isin(root, theirs)] = own
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return blocks.groupBy("pair").applyInPandas(work, "a long, b long")


def _labelled(lists: DataFrame, links: DataFrame) -> DataFrame:
    """lists with the column label: the component that the links put doc_id in."""
    of = components(links)
    return lists.join(of, F.col("doc_id") == F.col("node"), "left").select(
        *lists.columns, F.coalesce("root", "doc_id").alias("label")
    )


def _open_lists(lists: DataFrame) -> DataFrame:
    """The rows of lists that hold more than one label."""
    several = lists.groupBy("gram").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    return lists.join(several.select("gram"), "gram")


def _rest_of_long_lists(lists: DataFrame, docs: DataFrame, grams: Grams) -> DataFrame:
    """Links between different labels of long lists, found block against block."""
    hubs = lists.groupBy("gram").agg(F.min("doc_id").alias("hub"))
    group = components(lists.join(hubs, "gram").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")))
    members = lists.select("doc_id", "label", "size_block").distinct()
    members = members.join(group, F.col("doc_id") == F.col("node")).select(
        F.col("root").alias("group"), "size_block", "doc_id", "label"
    )
    members = stored(members)
    by_label = members.groupBy("group", "size_block", "label").agg(F.count(F.lit(1)).alias("n"))
    # a label that fills a block gets blocks of its own, so that they need not be compared to each other
    by_label = by_label.withColumn("own", F.when(F.col("n") >= BLOCK, F.col("label")))
    sizes = by_label.groupBy("group", "size_block", "own").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("parts"))
    sizes = stored(sizes)
    members = members.join(by_label.drop("n"), ["group", "size_block", "label"])
    same = lambda x, y: F.col(x).eqNullSafe(F.col(y))
    x = sizes.select([F.col(c).alias(f"x_{c}") for c in sizes.columns])
    y = sizes.select([F.col(c).alias(f"y_{c}") for c in sizes.columns])
    step = F.col("y_size_block") - F.col("x_size_block")
    alike = same("x_own", "y_own") & (F.col("x_size_block") == F.col("y_size_block"))
    after = (step == 1) | (
        (step == 0) & (F.coalesce("x_own", F.lit(-1 << 62)) <= F.coalesce("y_own", F.lit(-1 << 62)))
    )
    pairs = x.join(y, (F.col("x_group") == F.col("y_group")) & after)
    pairs = pairs.where(~(same("x_own", "y_own") & F.col("x_own").isNotNull()))
    until = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    pairs = pairs.withColumn("x_part", F.explode(until("x_parts"))).withColumn("y_part", F.explode(until("y_parts")))
    pairs = pairs.where(~alike | (F.col("x_part") <= F.col("y_part")))
    key = [f"{s}_{c}" for s in "xy" for c in ("group", "size_block", "own", "part")]
    pairs = pairs.withColumn("pair", F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in key]))
    itself = alike & (F.col("x_part") == F.col("y_part"))
    ends = pairs.select(
        "pair",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.when(itself, 2).otherwise(side).alias("side"),
                        *[F.col(f"{s}_{c}").alias(c) for c in ("group", "size_block", "own", "part")],
                    )
                    for side, s in ((0, "x"), (1, "y"))
                ]
            )
        ).alias("e"),
    ).select("pair", "e.*").distinct()
    members = members.join(
        sizes.select(*[F.col(c).alias(f"s_{c}") for c in sizes.columns]),
        (F.col("group") == F.col("s_group"))
        & (F.col("size_block") == F.col("s_size_block"))
        & same("own", "s_own"),
    ).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("s_parts")).cast("int"))
    members = members.select(*[F.col(c).alias(f"m_{c}") for c in ("group", "size_block", "own", "part", "doc_id", "label")])
    dealt = ends.join(
        members,
        (F.col("group") == F.col("m_group"))
        & (F.col("size_block") == F.col("m_size_block"))
        & (F.col("part") == F.col("m_part"))
        & same("own", "m_own"),
    ).select("pair", "side", F.col("m_doc_id").alias("doc_id"), F.col("m_label").alias("label"))
    dealt = stored(dealt)
    return _compare_blocks(dealt.join(texts_of(docs, dealt.select("doc_id")), "doc_id"), grams)


def links(docs: DataFrame, classes: DataFrame, grams: Grams) -> DataFrame:
    """a, b: enough links between classes that the components are those of all links.

    Each kind of link is stored by itself: the driver holds plans, threads and broadcasts of all that runs
    at once.
    """
    postings = classes.where("doc_id is not null and n_shingles > 0").select(
        "doc_id", grams.size_block(F.col("n_shingles")).alias("size_block"), F.explode("prefix").alias("gram")
    )
    shared = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    lists = stored(postings.join(shared, "gram"))
    # one pivot for each block of like size in each list, and neighbouring pivots with each other
    pivots = lists.groupBy("gram", "size_block").agg(F.min("doc_id").alias("pivot"))
    to_pivot = lists.join(pivots, ["gram", "size_block"]).select("doc_id", "pivot")
    upper = pivots.select("gram", (F.col("size_block") - 1).alias("size_block"), F.col("pivot").alias("doc_id"))
    to_pivot = to_pivot.union(pivots.join(upper, ["gram", "size_block"]).select("doc_id", "pivot"))
    pairs = lambda rows, x, y: rows.select(
        F.least(x, y).alias("a"), F.greatest(x, y).alias("b")
    ).where("a < b").distinct()
    found = stored(compare(pairs(to_pivot, "doc_id", "pivot"), docs, classes, grams))
    rest = stored(_open_lists(_labelled(lists, found)))
    short = rest.where(F.col("members") <= LONG_LIST)
    other = short.select("gram", F.col("doc_id").alias("o_doc"), F.col("label").alias("o_label"), F.col("size_block").alias("o_block"))
    near = (F.col("doc_id") < F.col("o_doc")) & (F.abs(F.col("size_block") - F.col("o_block")) <= 1)
    open_pairs = short.join(other, "gram").where(near & (F.col("label") != F.col("o_label")))
    open_pairs = stored(pairs(open_pairs, "doc_id", "o_doc"))
    if not open_pairs.isEmpty():
        found = found.union(stored(compare(open_pairs, docs, classes, grams)))
    long = rest.where(F.col("members") > LONG_LIST)
    if not long.isEmpty():
        found = found.union(stored(_rest_of_long_lists(long, docs, grams)))
    return found


def join(docs: DataFrame, grams: Grams = Grams()) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs.

    Words are what blanks, tabs and line ends separate, A-Z lower-cased. component_id is the smallest
    doc_id that links reach, itself included. Null and empty texts have an empty set and are linked with nothing; a
    text shorter than a gram is one gram. Rows that share a doc_id are one document with several texts:
    a link of any is a link of the document. Rows without doc_id get a component through equal texts
    only (null if there is none). Other columns are ignored; an empty table gives an empty result.
    """
    signed = stored(signatures(docs, grams))
    same_set = ["n_shingles", "set_a", "set_b"]
    classes = signed.where("n_shingles > 0").groupBy(*same_set).agg(
        F.min("doc_id").alias("doc_id"), F.first("prefix").alias("prefix")
    )
    classes = stored(classes)
    found = links(docs, classes, grams)
    # a document with several texts links the classes of its texts
    repeated = signed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null")
    repeated = stored(repeated.select("doc_id"))
    if not repeated.isEmpty():
        of_row = signed.select("doc_id", *same_set).join(repeated, "doc_id").join(
            classes.select(*same_set, F.col("doc_id").alias("class_id")), same_set
        )
        several = of_row.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.collect_set("class_id").alias("others"))
        several = several.select("a", F.explode("others").alias("b")).where("a != b")
        found = found.union(stored(several))
    found = components(found)
    roots = classes.join(found, F.col("doc_id") == F.col("node"), "left").select(
        *same_set, F.coalesce("root", "doc_id").alias("root")
    )
    # equal sets may hold a third of all rows: adaptive execution splits them, as nothing is grouped here
    joined = signed.select("doc_id", *same_set).join(roots, same_set, "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, grams: Grams = Grams(5, 80)) -> DataFrame:
    """docs without the rows whose component has a smaller doc_id; all columns kept.

    Rows that repeat the kept doc_id stay. Rows without a doc_id stay.
    """
    gone = join(docs, grams).where("component_id < doc_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("__id"), "left_anti")
