r"""Quality rules whose thresholds follow the data of each language and source.

Values of a document are put in logarithmic bins of 1 % relative error; counts per bin are a quantile
sketch: sketches merge by adding counts, in any order, with the same result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.frames import in_arrow
from tallyhouse.llm.storage import stored

ERROR = 0.01
GAMMA = (1 + ERROR) / (1 - ERROR)
LEAST_DOCS = 200  # a cell with fewer documents takes the sketch of its language, then that of all
#: rule -> (level in thousandths, reach): a fence stands ``reach`` times as far from the median as that quantile
#: of the cell; two-sided rules take the larger of their two distances. Levels leave room for the junk a cell may hold, reaches for the tail of its sound documents.
FENCES = {
    "symbol_share": (950, 1.0),
    "dup_line_share": (975, 2.0),
    "repeat_share": (975, 3.0),
    "word_length": (900, 3.0),
}
#: Distance from the median where neither the cell nor what it merges into has any spread at that level.
SLACK = {"symbol_share": 0.08, "dup_line_share": 0.25, "repeat_share": 0.3, "word_length": 3.0}
TWO_SIDED = ("word_length",)
FEW_LINES = 8  # texts of fewer lines count as having so many: one repeated line is no pattern yet
_SYMBOL = tx.byte_class(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
_COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def _key_by_row(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return tx.mixed(hashes + tx.mixed(rows.astype(np.uint64)))


def _counts(part: tx.Slice) -> dict[str, np.ndarray]:
    data, bounds = part.data, part.bounds
    w = tx.words(data, bounds, tx.SPACED)
    char = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    lines = tx.lines(data, bounds)
    line_rows = lines.rows
    has_word = np.searchsorted(w.starts, lines.ends) > np.searchsorted(w.starts, lines.starts)
    line_rows, starts, ends = line_rows[has_word], lines.starts[has_word], lines.ends[has_word]
    _, first = np.unique(_key_by_row(line_rows, tx.span_hashes(data, starts, ends)), return_index=True)
    again = np.ones(len(line_rows), bool)
    again[first] = False
    word_hash = tx.span_hashes(data, w.starts, w.ends)
    rows = w.rows
    at, runs = tx.runs_of(word_hash, w, 3)
    _, group, size = np.unique(_key_by_row(rows[at], runs), return_inverse=True, return_counts=True)
    at = at[size[group] > 1]
    covered = np.zeros(len(rows), bool)
    for k in range(3):
        covered[at + k] = True
    n = part.rows
    return {
        "n_words": w.counts,
        "word_chars": tx.sums_by_row(char[w.ends] - char[w.starts], w.first),
        "n_symbols": symbols[bounds[1:]] - symbols[bounds[:-1]],
        "n_lines": np.bincount(line_rows, minlength=n),
        "n_dup_lines": np.bincount(line_rows[again], minlength=n),
        "n_repeat_words": np.bincount(rows[covered], minlength=n),
    }


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text; null text counts as empty."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        tables = []
        for part in tx.slices(batch.column("text")):
            rows = batch.slice(part.first, part.rows).select(["doc_id", "lang", "source"])
            counts = {k: pa.array(v, pa.int64()) for k, v in _counts(part).items()}
            tables.append(pa.table({**dict(zip(rows.schema.names, rows.columns, strict=True)), **counts}))
        return pa.concat_tables(tables)

    taken = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    return in_arrow(taken, work, f"doc_id long, lang string, source string, {_COUNTS}")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _shares() -> dict[str, Column]:
    over = lambda a, b, least=1: F.col(a) / F.greatest(F.col(b), F.lit(least))
    return {
        "symbol_share": over("n_symbols", "word_chars"),
        "dup_line_share": over("n_dup_lines", "n_lines", FEW_LINES),
        "repeat_share": over("n_repeat_words", "n_words"),
        "word_length": over("word_chars", "n_words"),
    }


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, rule, bin) -> n: the quantile sketches of every cell. Bin null holds zeros.

    Only documents that pass the fixed rules are counted, so that junk does not set its own limits.
    """
    entry = [
        F.struct(F.lit(name).alias("rule"), value.alias("value")) for name, value in _shares().items()
    ]
    values = measured.where(~base_failed()).select("lang", "source", F.explode(F.array(*entry)).alias("e"))
    place = F.when(F.col("e.value") > 0, F.ceil(F.log(F.col("e.value")) / F.lit(math.log(GAMMA))).cast("int"))
    return values.groupBy("lang", "source", F.col("e.rule").alias("rule"), place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _per_rule(values: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("rule")]


def _quantiles(bins: DataFrame, by: list[str]) -> DataFrame:
    """docs, low, mid, high of each sketch: the median and the quantiles at the level of the rule and opposite it.

    A quantile is the first bin at which the count reaches the rank: its middle for the median, its outer edge
    for the others, so that the level's share of the documents lies within.
    """
    keys = [*by, "rule"]
    ordered = W.partitionBy(*keys).orderBy(F.col("bin").asc_nulls_first())
    ranked = (
        bins.groupBy(*keys, "bin")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(ordered))
        .withColumn("total", F.sum("n").over(W.partitionBy(*keys)))
        .withColumn("edge", F.when(F.col("bin").isNull(), 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bin"))))
        .withColumn("level", _per_rule({name: level for name, (level, _) in FENCES.items()}))
    )

    def at(level: Column | int) -> Column:
        return F.min(F.when(1000 * F.col("upto") >= F.col("total") * level, F.col("edge")))

    return ranked.groupBy(*keys).agg(
        F.max("total").alias("docs"),
        (at(1000 - F.col("level")) / F.lit(GAMMA)).alias("low"),
        (at(500) * F.lit(2 / (GAMMA + 1))).alias("mid"),
        at(F.col("level")).alias("high"),
    )


def thresholds(bins: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, rule) -> low, high, by_data.

    Cells with few documents, or without spread at the level of the rule, use the merged sketch of their language,
    then that of all. ``by_data`` is false where none of them has spread, and the constants of SLACK decide.
    """
    quantiles = F.struct("docs", "low", "mid", "high")
    cell = _quantiles(bins, ["lang", "source"]).select("lang", "source", "rule", quantiles.alias("of_cell"))
    by_lang = _quantiles(bins, ["lang"]).select(
        F.col("lang").alias("l_lang"), F.col("rule").alias("l_rule"), quantiles.alias("of_lang")
    )
    overall = _quantiles(bins, []).select(F.col("rule").alias("a_rule"), quantiles.alias("of_all"))
    joined = cell.join(
        by_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("rule") == F.col("l_rule"))
    ).join(overall, F.col("rule") == F.col("a_rule"))

    def distance(q: Column) -> Column:
        above = q["high"] - q["mid"]
        return F.when(F.col("rule").isin(*TWO_SIDED), F.greatest(above, q["mid"] - q["low"])).otherwise(above)

    # the edges of the median's own bin are nearer to it than its own relative width
    has_spread = lambda q: distance(q) > q["mid"] * (GAMMA - 1)
    large = F.filter(F.array("of_cell", "of_lang"), lambda q: q["docs"] >= least_docs)
    levels = F.concat(large, F.array("of_all"))
    spread = F.get(F.filter(levels, has_spread), F.lit(0))
    reach = _per_rule({name: reach for name, (_, reach) in FENCES.items()})
    chosen = joined.select(
        "lang", "source", "rule", spread.isNotNull().alias("by_data"),
        F.coalesce(spread, F.get(levels, F.lit(0))).alias("q"),
    )
    away = F.when(F.col("by_data"), reach * distance(F.col("q"))).otherwise(_per_rule(SLACK))
    low = F.when(F.col("rule").isin(*TWO_SIDED), F.col("q.mid") - away).otherwise(F.lit(-1.0))
    return chosen.select(
        "lang", "source", "rule", low.alias("low"), (F.col("q.mid") + away).alias("high"), "by_data"
    )


def judge(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, counts, base_failed and kept for every row of docs.

    A document is kept if it passes the fixed rules and all its shares lie within the fences of its
    language and source, which follow the quantiles named in FENCES. Null languages and sources are cells of their own; null and empty texts have no words
    and fail; repeated rows are judged each; an empty table gives an empty result.
    """
    measured = stored(measure(docs))
    fences = thresholds(sketch(measured), least_docs)
    wide = fences.groupBy("lang", "source").agg(
        *[
            F.max(F.when(F.col("rule") == name, F.struct("low", "high"))).alias(f"fence_{name}")
            for name in SLACK
        ]
    ).withColumnRenamed("lang", "f_lang").withColumnRenamed("source", "f_source")
    joined = measured.join(
        wide,
        F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")),
        "left",
    )
    within = F.lit(True)
    for name, value in _shares().items():
        fence = F.col(f"fence_{name}")
        within = within & (value >= fence["low"]) & (value <= fence["high"])
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        F.when(base_failed(), F.lit(False)).otherwise(F.coalesce(within, F.lit(True))).alias("kept"),
    )
