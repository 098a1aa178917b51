"""Near-duplicates by an inverted join over the coordinates of MinHash signatures.

Documents with the same set of shingles are one class. A class has 64 coordinates, each the least value of
one hash over its shingles; two sets agree in a coordinate as often as their Jaccard similarity says. A class
is posted under each pair of coordinate and value, and pairs that collide in at least 34 are retained: two
sets with a similarity of 0.85 collide in fewer with a probability of 3e-10. What is retained is confirmed on
the full sets.

Collisions are counted without merging whole lists:

* values that one class alone has are skipped, then classes with fewer than 34 values left;
* of the rest only a prefix is merged, the rarest values but for the last 33 of the 64: two classes that
  collide in 34 share one of it. The skipped, longer lists are looked up for candidates only;
* classes in one list are compared with a pivot first; what links to it is one component. Lists whose
  classes are all in one component are skipped, and so are pairs inside a component;
* for classes in lists that are still open, the shingles that no other of them has are counted. They
  bound the similarity of every pair, so that copies with many changes of their own are not paired off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.components import components
from tallyhouse.llm.frames import in_arrow
from tallyhouse.llm.ngram_join import Grams, confirmed, gram_sets, texts_of
from tallyhouse.llm.storage import stored

LONG_LIST = 64  # lists with more classes left are compared block against block
BLOCK = 512  # classes in a block
PAIRS_A_PART = 256  # pairs of one class that are looked up together
STARS = 2  # rounds of pivots before what is left is compared in full


@dataclass(frozen=True)
class Signature:
    """Collisions in at least ``matches`` of ``coordinates`` make a candidate."""

    coordinates: int = 64
    matches: int = 34

    @property
    def prefix(self) -> int:
        return self.coordinates - self.matches + 1

    def values(self, gram: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A row of coordinate-value pairs, as one number each, for every set gram[first[i]:first[i+1]] (none empty)."""
        salts = tx.mixed(np.arange(2 * self.coordinates, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        out = np.empty((len(first) - 1, self.coordinates), np.uint64)
        for k in range(self.coordinates):
            hashed = (gram ^ salts[2 * k]) * (salts[2 * k + 1] | np.uint64(1))
            out[:, k] = tx.mixed(np.minimum.reduceat(hashed, first[:-1]) ^ salts[2 * k + 1])
        return out


def signatures(docs: DataFrame, grams: Grams, signature: Signature) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (a 128-bit hash of the set), pairs (its coordinate-value pairs, none for an empty set)."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        out = []
        for part in tx.slices(batch.column("text")):
            row, gram = gram_sets(part.data, part.bounds, grams.n)
            first = np.searchsorted(row, np.arange(part.rows + 1))
            size = np.diff(first)
            both = [tx.sums_by_row(tx.mixed(gram + np.uint64(salt)), first) for salt in (1, 2)]
            some = np.flatnonzero(size)
            values = signature.values(gram, np.append(first[some], len(gram))) if len(some) else np.empty(0, np.uint64)
            upto = np.concatenate([[0], np.cumsum((size > 0) * signature.coordinates)])
            out.append(
                pa.table(
                    {
                        "doc_id": batch.column("doc_id").slice(part.first, part.rows),
                        "n_shingles": pa.array(size, pa.int64()),
                        "set_a": tx.signed(both[0]),
                        "set_b": tx.signed(both[1]),
                        "pairs": pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(tx.signed(values.ravel()))),
                    }
                )
            )
        return pa.concat_tables(out)

    schema = "doc_id long, n_shingles long, set_a long, set_b long, pairs array<long>"
    return in_arrow(docs.select("doc_id", "text"), work, schema)


def prefix_lists(classes: DataFrame, grams: Grams, signature: Signature) -> DataFrame:
    """pair, doc_id, size_block: the postings that are merged, rarest pairs of each class, no pair with one class alone."""
    postings = classes.where("doc_id is not null").select(
        "doc_id", grams.size_block(F.col("n_shingles")).alias("size_block"), F.explode("pairs").alias("pair")
    )
    shared = postings.groupBy("pair").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    own = Window.partitionBy("doc_id")
    ranked = postings.join(shared, "pair").select(
        "*",
        F.row_number().over(own.orderBy("members", "pair")).alias("nth"),
        F.count(F.lit(1)).over(own).alias("left"),
    )
    # pairs of one class alone come first in the order and take up their part of the prefix
    return ranked.where(F.col("nth") <= F.col("left") - (signature.matches - 1)).select("pair", "doc_id", "size_block")


def _ends(rows: DataFrame, x: str, y: str) -> DataFrame:
    """The distinct pairs (a, b) of two columns, a < b."""
    return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a < b").distinct()


def retained(candidates: DataFrame, classes: DataFrame, signature: Signature) -> DataFrame:
    """The (a, b) that collide in enough coordinates. A class with many pairs is dealt out in parts."""
    degrees = candidates.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_A_PART).cast("int").alias("parts"))
    degrees = stored(degrees)
    of = lambda c: classes.select(F.col("doc_id").alias(c), F.col("pairs").alias(f"pairs_{c}"))
    left = degrees.join(of("a"), "a").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = candidates.join(degrees, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    both = right.drop("parts").join(of("b"), "b").join(left.drop("parts"), ["a", "part"])
    collisions = F.size(F.array_intersect("pairs_a", "pairs_b"))
    return both.where(collisions >= signature.matches).select("a", "b")


def _labelled(lists: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of lists that are in more than one component, with their component as label."""
    of = components(links)
    rows = lists.drop("label").join(of, F.col("doc_id") == F.col("node"), "left").select(
        "pair", "doc_id", "size_block", F.coalesce("root", "doc_id").alias("label")
    )
    open_lists = rows.groupBy("pair").agg(
        F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("members")
    )
    return rows.join(open_lists.where("x < y").select("pair", "members"), "pair")


def _to_pivots(lists: DataFrame, turn: int) -> DataFrame:
    """(a, b): every class with the pivot of its list among classes of like size, and neighbouring pivots."""
    place = F.struct((F.lit(0) if turn == 0 else F.xxhash64("doc_id", F.lit(turn))).alias("place"), "doc_id")
    pivots = lists.groupBy("pair", "size_block").agg(F.min(place)["doc_id"].alias("pivot"))
    rows = lists.join(pivots, ["pair", "size_block"]).select("doc_id", "pivot")
    upper = pivots.select("pair", (F.col("size_block") - 1).alias("size_block"), F.col("pivot").alias("doc_id"))
    return _ends(rows.union(pivots.join(upper, ["pair", "size_block"]).select("doc_id", "pivot")), "doc_id", "pivot")


def _bounded(lists: DataFrame, classes: DataFrame, docs: DataFrame, grams: Grams) -> DataFrame:
    """lists with n, the size of the class's set, and common, how many of it another class in lists has too.

    Classes of which no set could have enough are left out: a partner shares percent of n at least.
    """
    ids = lists.select("doc_id").distinct()

    def work(batch: pa.RecordBatch) -> pa.Table:
        out = []
        for part in tx.slices(batch.column("text")):
            row, gram = gram_sets(part.data, part.bounds, grams.n)
            key = batch.column("doc_id").slice(part.first, part.rows).take(pa.array(row))
            out.append(pa.table({"doc_id": key, "gram": tx.signed(gram)}))
        return pa.concat_tables(out)

    # rows that repeat a doc_id with another text only add shingles: the bound gets weaker, never wrong
    held = in_arrow(texts_of(docs, ids), work, "doc_id long, gram long")
    alone = held.groupBy("gram").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last")).where("doc_id = last")
    alone = alone.groupBy("doc_id").agg(F.count(F.lit(1)).alias("alone"))
    sizes = classes.join(ids, "doc_id", "left_semi").select("doc_id", F.col("n_shingles").alias("n"))
    sizes = sizes.join(alone, "doc_id", "left").select(
        "doc_id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common")
    )
    return lists.join(sizes.where(100 * F.col("common") >= grams.percent * F.col("n")), "doc_id")


def _between_labels(lists: DataFrame, classes: DataFrame, grams: Grams, signature: Signature) -> DataFrame:
    """(a, b): all pairs of classes in a list that are in different components, not ruled out, and collide enough."""
    short = lists.where(F.col("members") <= LONG_LIST)
    other = short.select("pair", *[F.col(c).alias(f"o_{c}") for c in ("doc_id", "label", "n", "common")])
    most = F.least("common", "o_common")
    possible = 100 * most >= grams.percent * (F.col("n") + F.col("o_n") - most)
    pairs = short.join(other, "pair").where((F.col("doc_id") < F.col("o_doc_id")) & (F.col("label") != F.col("o_label")) & possible)
    found = retained(stored(_ends(pairs, "doc_id", "o_doc_id")), classes, signature)
    long = lists.where(F.col("members") > LONG_LIST)
    if not long.isEmpty():
        found = found.union(_block_pairs(long, classes, grams, signature)).distinct()
    return found


def _block_pairs(lists: DataFrame, classes: DataFrame, grams: Grams, signature: Signature) -> DataFrame:
    """What _between_labels() gives for long lists: blocks of a list against blocks of it of like size.

    Two classes meet in every list that both are in; the least of these lists answers for them.
    """
    import pandas as pd

    posted = lists.groupBy("doc_id").agg(F.collect_list("pair").alias("posted"))  # a prefix at most
    sizes = stored(
        lists.groupBy("pair", "size_block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    )
    upper = sizes.select("pair", (F.col("size_block") - 1).alias("size_block"), F.col("blocks").alias("upper"))
    numbers = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    inside = sizes.withColumn("x", F.explode(numbers("blocks"))).withColumn("y", F.explode(numbers("blocks")))
    inside = inside.where("x <= y").select("pair", "size_block", "x", F.col("size_block").alias("y_block"), "y")
    across = sizes.join(upper, ["pair", "size_block"]).withColumn("x", F.explode(numbers("blocks")))
    across = across.withColumn("y", F.explode(numbers("upper")))
    across = across.select("pair", "size_block", "x", (F.col("size_block") + 1).alias("y_block"), "y")
    meetings = inside.union(across).withColumn("meeting", F.concat_ws(":", "pair", "size_block", "x", "y_block", "y"))
    alone = (F.col("size_block") == F.col("y_block")) & (F.col("x") == F.col("y"))
    sides = meetings.select("meeting", "pair", "size_block", F.col("x").alias("block"), F.when(alone, 2).otherwise(0).alias("side"))
    sides = sides.union(
        meetings.where(~alone).select("meeting", "pair", F.col("y_block"), F.col("y"), F.lit(1))
    )
    members = lists.join(sizes, ["pair", "size_block"]).withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    )
    dealt = members.join(sides, ["pair", "size_block", "block"]).select(
        "meeting", "pair", "side", "doc_id", "label", "n", "common"
    )
    dealt = dealt.join(classes.select("doc_id", "pairs").join(posted, "doc_id"), "doc_id")

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.stack(rows["pairs"].to_list())
        listed = np.stack([np.isin(v, p) for v, p in zip(values, rows["posted"], strict=True)])
        this, none = rows["pair"].iloc[0], np.iinfo(np.int64).max
        side, ids, label, n, common = (rows[c].to_numpy() for c in ("side", "doc_id", "label", "n", "common"))
        right = np.flatnonzero(side != 0)
        out = []
        for i in np.flatnonzero(side != 1):
            most = np.minimum(common[right], common[i])
            hit = right[(100 * most >= grams.percent * (n[right] + n[i] - most)) & (label[right] != label[i])]
            same = values[hit] == values[i]
            enough = same.sum(axis=1) >= signature.matches
            hit, same = hit[enough], same[enough] & listed[hit[enough]] & listed[i]
            hit = hit[np.where(same, values[i], none).min(axis=1, initial=none) == this]
            out.append(np.stack([np.minimum(ids[hit], ids[i]), np.maximum(ids[hit], ids[i])], axis=1))
        pairs = np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy("meeting").applyInPandas(work, "a long, b long")


def links(docs: DataFrame, classes: DataFrame, grams: Grams, signature: Signature) -> DataFrame:
    """a, b: enough confirmed links between classes that their components are those of all links."""
    lists = stored(prefix_lists(classes, grams, signature))
    found, left = None, lists
    for turn in range(STARS):
        near = stored(retained(stored(_to_pivots(left, turn)), classes, signature))
        new = confirmed(near, docs, grams)
        found = stored(new if found is None else found.union(new))
        left = stored(_labelled(left, found))
    for _ in range(2):  # what goes in the first round leaves others with less in common
        left = stored(_bounded(left.drop("n", "common"), classes, docs, grams))
    rest = stored(_between_labels(left, classes, grams, signature))
    return found if rest.isEmpty() else found.union(confirmed(rest, docs, grams))


def near_duplicates(docs: DataFrame, grams: Grams = Grams(5, 85), signature: Signature = Signature()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs.

    Words are what blanks, tabs and line ends separate, A-Z lower-cased. component_id is the smallest
    doc_id that links reach, itself included; kept marks the rows that bear it. Null and empty texts have an
    empty set and are linked with nothing; a text shorter than a shingle is one. Rows that share a doc_id are
    one document with several texts: a link of any is a link of the document. Rows without doc_id get a
    component through equal texts only (null if there is none; kept is then true, as nothing stands for
    them). Other columns are ignored; an empty table gives an empty result.
    """
    signed = stored(signatures(docs, grams, signature))
    same_set = ["n_shingles", "set_a", "set_b"]
    classes = signed.where("n_shingles > 0").groupBy(*same_set).agg(
        F.min("doc_id").alias("doc_id"), F.first("pairs").alias("pairs")
    )
    classes = stored(classes)
    of_row = signed.select("doc_id", *same_set).join(
        classes.select(*same_set, F.col("doc_id").alias("class_id")), same_set, "left"
    )
    repeated = signed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null")
    several = of_row.join(repeated, "doc_id").groupBy("doc_id").agg(
        F.min("class_id").alias("a"), F.collect_set("class_id").alias("others")
    )
    several = several.select("a", F.explode("others").alias("b")).where("a != b")
    found = components(links(docs, classes, grams, signature).union(several))
    roots = classes.join(found, F.col("doc_id") == F.col("node"), "left").select(
        *same_set, F.coalesce("root", "doc_id").alias("root")
    )
    joined = signed.select("doc_id", *same_set).join(roots, same_set, "left")
    component = F.coalesce("root", "doc_id")
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept")
    )


def without_copies(docs: DataFrame, grams: Grams = Grams(5, 85)) -> DataFrame:
    """docs without the rows whose component has a smaller doc_id; all columns kept.

    Rows that repeat a kept doc_id stay, and so do rows without a doc_id.
    """
    gone = near_duplicates(docs, grams).where("component_id < doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
