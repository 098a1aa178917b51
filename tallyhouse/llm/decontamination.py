"""Finding benchmark passages in documents through a positional inverted index.

The index holds, for every term that some benchmark window is looked up by, each place in the
documents: term, document, position and the neighbourhood (hashes of the words up to WINDOW - 1 before and
after). A window is looked up from its rarest term; the list of its second rarest term is intersected at the
window's offset through the neighbourhood; what is left is compared word by word. Words are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.frames import in_arrow
from tallyhouse.llm.storage import stored

WINDOW = 13
BLOCK_WORDS = 1_000_000  # words of benchmark items looked up in one pass: 8 MB of terms are broadcast
FEW_QUESTIONS = 100_000  # windows that are broadcast, about 300 bytes each; 30 MB at most


def _hashed(part: tx.Slice) -> tuple[tx.Spans, np.ndarray]:
    data = tx.LOWER[part.data]
    w = tx.words(data, part.bounds, tx.ALNUM)
    return w, tx.signed(tx.span_hashes(data, w.starts, w.ends))


def _lists(values: np.ndarray, first: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    items = pa.array(values, pa.int64(), mask=None if valid is None else ~valid)
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), items)


def tokens(items: DataFrame) -> DataFrame:
    """(item_id, text) -> item_id, words array<long>; items without a word are left out."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        tables = []
        for part in tx.slices(batch.column("text")):
            w, h = _hashed(part)
            ids = batch.column("item_id").slice(part.first, part.rows)
            tables.append(pa.table({"item_id": ids, "words": _lists(h, w.first)}))
        return pa.concat_tables(tables)

    found = in_arrow(items.select("item_id", "text"), work, "item_id long, words array<long>")
    return found.where(F.size("words") > 0)


def _where(sorted_terms: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Indexes into h of the words that are among sorted_terms."""
    if not len(sorted_terms):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(sorted_terms, h), len(sorted_terms) - 1)
    return np.flatnonzero(sorted_terms[at] == h)


def term_counts(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """How often each of the sorted terms stands in the documents: term, n (absent terms are left out)."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        total = np.zeros(len(terms), np.int64)
        for part in tx.slices(batch.column("text")):
            _, h = _hashed(part)
            at = _where(terms, h)
            total += np.bincount(np.searchsorted(terms, h[at]), minlength=len(terms))
        seen = np.flatnonzero(total)
        return pa.table({"term": pa.array(terms[seen]), "n": pa.array(total[seen])})

    counts = in_arrow(docs.select("text"), work, "term long, n long")
    return counts.groupBy("term").agg(F.sum("n").alias("n"))


def lookups(items: DataFrame, terms: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> DataFrame:
    """The questions put to the index, one for each run of windows with the same two rarest words.

    item_id, term (the rarest), second (the next; null in windows of one word), shift (its place
    relative to term), at (the term's place in the item), low, high (first places of the run's windows),
    span (words of a window), context (the item's words around the term). Ties go to the earlier word.
    """
    reach = window - 1

    def work(batch: pa.RecordBatch) -> pa.Table | None:
        out = []
        for item, words in zip(batch.column("item_id").to_pylist(), batch.column("words").to_pylist(), strict=True):
            h = np.array(words, np.int64)
            rare = counts[np.searchsorted(terms, h)]
            span = min(window, len(h))
            views = np.lib.stride_tricks.sliding_window_view(rare, span)
            order = np.argsort(views, axis=1, kind="stable")[:, :2]
            start = np.arange(len(views))
            first = order[:, 0] + start
            other = (order[:, 1] if span > 1 else order[:, 0]) + start
            new = np.flatnonzero(np.r_[True, (np.diff(first) != 0) | (np.diff(other) != 0)])
            for a, b in zip(new, np.r_[new[1:], len(first)], strict=True):
                p, q = int(first[a]), int(other[a])
                around = [int(h[i]) if 0 <= i < len(h) else None for i in range(p - reach, p + reach + 1)]
                out.append((item, int(h[p]), int(h[q]) if q != p else None, q - p, p, int(a), int(b) - 1, span, around))
        names = ("item_id", "term", "second", "shift", "at", "low", "high", "span", "context")
        kinds = [pa.int64()] * 3 + [pa.int32()] * 5 + [pa.list_(pa.int64())]
        if not out:
            return None
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], list(names))

    schema = "item_id long, term long, second long, shift int, at int, low int, high int, span int, context array<long>"
    return in_arrow(items, work, schema)


def build_index(docs: DataFrame, terms: np.ndarray, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per row of docs: doc_id, text_key, n_words, postings (term, pos, around) of the sorted terms.

    The neighbourhood is wide enough for proximities() within slop words; phrases() takes an index without slop.
    """
    reach = max(window - 1, slop)
    steps = np.arange(-reach, reach + 1)

    def work(batch: pa.RecordBatch) -> pa.Table:
        tables = []
        for part in tx.slices(batch.column("text")):
            w, h = _hashed(part)
            at = _where(terms, h)
            rows = w.rows[at]
            near = at[:, None] + steps[None, :]
            valid = (near >= w.first[rows][:, None]) & (near < w.first[rows + 1][:, None])
            values = h[np.clip(near, 0, max(len(h) - 1, 0))].ravel() if len(at) else np.empty(0, np.int64)
            around = _lists(values, np.arange(len(at) + 1) * len(steps), valid.ravel())
            posting = pa.StructArray.from_arrays(
                [pa.array(h[at]), pa.array((at - w.first[rows]).astype(np.int32)), around], ["term", "pos", "around"]
            )
            offsets = np.searchsorted(rows, np.arange(part.rows + 1))
            keys = batch.slice(part.first, part.rows)
            tables.append(
                pa.table(
                    {
                        "doc_id": keys.column("doc_id"),
                        "text_key": keys.column("text_key"),
                        "n_words": pa.array(w.counts, pa.int64()),
                        "postings": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), posting),
                    }
                )
            )
        return pa.concat_tables(tables)

    schema = (
        "doc_id long, text_key long, n_words long, "
        "postings array<struct<term: long, pos: int, around: array<long>>>"
    )
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return in_arrow(keyed, work, schema)


def _equal_run(equal: Column, reach: int) -> Column:
    """How many of the first ``reach`` flags are true before the first false one."""
    at = F.array_position(equal, False)
    return F.when(at == 0, reach).otherwise(at - 1).cast("int")


def _to_postings(questions: DataFrame, few: int) -> DataFrame:
    """The questions, to be broadcast if counted to be few; beyond that both sides are shuffled by term, where
    adaptive execution splits the frequent ones. questions is a stored table, so counting it reads no text."""
    return F.broadcast(questions) if questions.count() <= few else questions.hint("merge")


def phrases(
    index: DataFrame, questions: DataFrame, window: int = WINDOW, few: int = FEW_QUESTIONS
) -> DataFrame:
    """Exact matches: doc_id, text_key, item_id, first, last (places of the document's hit words).

    Up to ``few`` questions are broadcast, more are joined by a shuffle.
    """
    reach = window - 1
    posting = index.select("doc_id", "text_key", F.explode("postings").alias("p")).select(
        "doc_id", "text_key", F.col("p.term").alias("p_term"), F.col("p.pos").alias("pos"), F.col("p.around").alias("around")
    )
    second_there = F.col("second").isNull() | (
        F.element_at("around", F.col("shift") + (reach + 1)) == F.col("second")
    )
    met = posting.join(_to_postings(questions, few), (F.col("p_term") == F.col("term")) & second_there)
    same = F.zip_with("around", "context", lambda a, b: F.coalesce(a == b, F.lit(False)))
    met = met.withColumn("same", same)
    met = met.withColumn("left", _equal_run(F.reverse(F.slice("same", 1, reach)), reach))
    met = met.withColumn("right", _equal_run(F.slice("same", reach + 2, reach), reach))
    begin = F.greatest("low", F.col("at") - F.col("left"))
    end = F.least("high", F.col("at") + F.col("right") - F.col("span") + 1)
    return (
        met.withColumn("begin", begin)
        .withColumn("finish", end)
        .where("begin <= finish")
        .select(
            "doc_id",
            "text_key",
            "item_id",
            (F.col("pos") - F.col("at") + F.col("begin")).alias("first"),
            (F.col("pos") - F.col("at") + F.col("finish") + F.col("span") - 1).alias("last"),
        )
    )


def proximities(index: DataFrame, questions: DataFrame, slop: int, few: int = FEW_QUESTIONS) -> DataFrame:
    """Places where a window's two rarest words stand within ``slop`` words of each other, in any order.

    doc_id, text_key, item_id, pos (of the rarest), distance (of the nearest second word). An index whose
    neighbourhoods are narrower than slop is an error: matches further away would be missed.
    """
    reach = F.expr("int(size(around) div 2)")
    posting = index.select("doc_id", "text_key", F.explode("postings").alias("p")).select(
        "doc_id", "text_key", F.col("p.term").alias("p_term"), F.col("p.pos").alias("pos"), F.col("p.around").alias("around")
    )
    met = posting.join(_to_postings(questions.where("second is not null"), few), F.col("p_term") == F.col("term"))
    places = F.transform("around", lambda a, i: F.when((a == F.col("second")) & (i != reach), F.abs(i - reach)))
    narrow = F.raise_error(F.lit(f"build the index with slop={slop}: its neighbourhoods are narrower")).cast("int")
    distance = F.when(reach >= slop, F.array_min(places)).otherwise(narrow)
    near = met.withColumn("distance", distance).where(F.col("distance") <= slop)
    return near.groupBy("doc_id", "text_key", "item_id", "pos").agg(F.min("distance").alias("distance"))


def _terms(rows: DataFrame, column: str) -> np.ndarray:
    """The distinct longs of a column, sorted; callers bound how many there are."""
    found = rows.select(column).distinct().toArrow().column(0).to_numpy()
    return np.sort(found.astype(np.int64))


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS):
    """(sizes, hits): sizes has doc_id, text_key, n_words of every row of docs; hits as phrases() gives them.

    Items are looked up in blocks of about block_words words, each against all documents, so the terms held
    do not grow with the benchmark (an item of more words makes a block larger by itself).
    """
    items = stored(tokens(benchmark))
    words = items.agg(F.sum(F.size("words"))).first()[0] or 0
    n = max(1, -(-words // block_words))
    sizes, hits = None, None
    for i in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) if n > 1 else items
        terms = _terms(block.select(F.explode("words").alias("term")), "term")
        counted = term_counts(docs, terms).toArrow()
        counts = np.zeros(len(terms), np.int64)
        counts[np.searchsorted(terms, counted.column("term").to_numpy())] = counted.column("n").to_numpy()
        questions = stored(lookups(block, terms, counts, window))
        # windows whose rarest word is nowhere need no list
        index = stored(build_index(docs, _terms(questions, "term"), window))
        found = phrases(index, questions, window)
        sizes = sizes if sizes is not None else index.select("doc_id", "text_key", "n_words")
        hits = found if hits is None else hits.unionByName(found)
    return sizes, hits


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of docs: doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is ``window`` words of an item in a row, or all words of a shorter item; n_hit counts the
    document's words inside any occurrence of one. Contaminated: a hit, and a twentieth of the words hit.
    Null and empty texts have no words; items without words match nothing; repeated rows are judged each;
    rows with the same doc_id and different texts are kept apart by a hash of the text. Empty tables give
    an empty result or no hits. Other columns are ignored.
    """
    sizes, hits = find(docs, benchmark, window)
    hits = stored(hits)
    document = ["doc_id", "text_key"]
    spans = hits.select(*document, "first", "last").distinct()
    before = W.partitionBy(*document).orderBy("first", "last").rowsBetween(W.unboundedPreceding, -1)
    reached = F.coalesce(F.max("last").over(before), F.lit(-1))
    new = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first") - 1, F.col("reached")))
    n_hit = spans.withColumn("reached", reached).groupBy(*document).agg(F.sum(new).alias("n_hit"))
    items = hits.groupBy(*document).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    per_document = n_hit.join(items.withColumnsRenamed({"doc_id": "d", "text_key": "k"}),
                              F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
    per_document = per_document.select(F.col("d").alias("h_doc"), F.col("k").alias("h_key"), "n_hit", "items")
    joined = sizes.join(
        per_document,
        F.col("doc_id").eqNullSafe(F.col("h_doc")) & (F.col("text_key") == F.col("h_key")),
        "left",
    )
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id",
        "text_key",
        "n_words",
        n.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed).cast("binary"), 256).alias("items_sha256"),
        ((n > 0) & (20 * n >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs that are not contaminated, all columns kept."""
    bad = contamination(docs, benchmark, window).where("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")
    ).distinct()
    return docs.join(
        bad, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__key")), "left_anti"
    )
