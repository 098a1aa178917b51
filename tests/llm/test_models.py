"""Trained operators: held-out accuracy on the supplied tables, gradients, and odd rows."""

import zlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import language, quality_model, toxicity
from tallyhouse.llm import text as tx
from tests.compare import DATA
from tests.llm.cases import documents, odd_rows, with_clashes

FOLDER = str(DATA / "sf0.01")


def read(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def held_out(doc_id, modulus, remainder):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % modulus == remainder


def scored(spark, column, module):
    labels = read(spark, "labels").selectExpr("doc_id", f"{column} AS label")
    found = module.classify(read(spark, "documents"), labels).collect()
    assert len(found) == read(spark, "documents").count()
    assert all(r.held_out == held_out(r.doc_id, *module.HELD_OUT) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    truth = {r.doc_id: r.label for r in labels.collect()}
    return [(truth[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in truth]


def test_quality_of_held_out_documents(spark):
    pairs = scored(spark, "quality", quality_model)
    assert np.mean([y == p for y, p in pairs]) > 0.93


def test_toxicity_of_held_out_documents(spark):
    pairs = scored(spark, "toxic", toxicity)
    clean = [p for y, p in pairs if y == 0]
    toxic = [p for y, p in pairs if y == 1]
    assert np.mean(clean) < 0.05 and np.mean(toxic) > 0.6


def test_toxicity_keeps_the_share_of_labels_that_its_sample_cuts(spark):
    ids = [i for i in range(400) if not held_out(i, *toxicity.HELD_OUT)]
    rows = [(i, f"some plain words {i} " + ("vile" if i % 10 == 0 else "kind")) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in ids], "doc_id long, label int")
    first = [r.doc_id for y in (0, 1) for r in labels.where(f"label = {y}").orderBy(F.xxhash64("doc_id")).limit(6).collect()]
    cut = toxicity.fit(docs, labels, max_docs=6)
    even = toxicity.fit(docs, labels.where(F.col("doc_id").isin(first)), max_docs=6)
    toxic = sum(i % 10 == 0 for i in ids)
    assert np.allclose(cut.out[:-1], even.out[:-1], rtol=1e-3)
    assert cut.out[-1] - even.out[-1] == pytest.approx(np.log(toxic / (len(ids) - toxic)), rel=1e-2)


def test_toxicity_is_fitted_on_every_label_of_the_largest_table(spark):
    labels = spark.read.parquet(str(DATA / "sf0.1/labels.parquet")).select("doc_id", "toxic").distinct().collect()
    train = [r.toxic for r in labels if not held_out(r.doc_id, *toxicity.HELD_OUT)]
    assert max(train.count(0), train.count(1)) <= toxicity.MAX_DOCS


def test_language_of_held_out_documents(spark):
    docs = read(spark, "documents")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    found = language.identify(docs).collect()
    assert all(r.held_out == held_out(r.doc_id, *language.HELD_OUT) for r in found)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in found if r.held_out]) > 0.98


@pytest.mark.parametrize("module", [quality_model, toxicity])
def test_models_on_odd_rows(spark, module):
    docs = with_clashes(documents(spark, odd_rows()))
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (8, 0), (9, 0), (10, None), (None, 1)], "doc_id long, label int")
    found = module.classify(docs, labels).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (3, 4, 5)}) == 1
    none = module.classify(docs, labels.limit(0)).collect()
    assert len(none) == len(odd_rows()) and all(0 <= r.score <= 1 for r in none)
    assert module.classify(docs.limit(0), labels).count() == 0


def test_language_of_odd_rows(spark):
    rows = [*odd_rows(), (50, "1234 !?", "en", "a", 1)]
    found = language.identify(with_clashes(documents(spark, rows))).collect()
    assert len(found) == len(rows)
    unknown = {r.doc_id for r in found if r.lang_pred == "und"}
    assert unknown == {3, 4, 5, 50, None} and all(r.score == 0 for r in found if r.lang_pred == "und")
    unlearned = language.score(documents(spark, rows), language.fit(documents(spark, rows).limit(0))).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}


def test_gradients_of_the_network():
    texts = [" ".join(f"t{(7 * i + j) % 23}x" for j in range(40)) for i in range(6)]
    part = next(tx.slices(pa.array(texts), most=1 << 40))
    words = toxicity.read(part.data, part.bounds)
    _, start, size = toxicity.windows(words.first)
    label = (np.arange(len(start)) % 2).astype(np.float32)
    net = toxicity.fresh()
    net = replace(net, **{k: getattr(net, k).astype(np.float64) for k in net.names()})
    _, grad, slots = toxicity.gradients(net, words, start, size, label)
    for k in net.names():
        g = getattr(grad, k)
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        place = (slots[at[0]], *at[1:]) if k == "word" else at
        losses = []
        for step in (1e-3, -1e-3):
            moved = getattr(net, k).copy()
            moved[place] += step
            losses.append(toxicity.gradients(replace(net, **{k: moved}), words, start, size, label)[0])
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(g[at], rel=1e-2, abs=1e-6)


def test_windows_overlap_and_cover_every_word():
    first = np.array([0, 0, 10, 42, 75, 300])
    row, start, size = toxicity.windows(first)
    covered = [set() for _ in range(5)]
    for r, s, n in zip(row, start, size, strict=True):
        covered[r] |= set(range(s, s + n))
        assert n <= toxicity.WINDOW
    assert covered == [set(range(a, b)) for a, b in zip(first[:-1], first[1:], strict=True)]


def test_repetition_of_any_word_shares_a_feature():
    part = next(tx.slices(pa.array(["never never seen", "other other word"])))
    slots, values, first = quality_model.features(part)
    assert 0 in slots[: first[1]] and 0 in slots[first[1] :]
    assert np.sum(values[: first[1]] ** 2) == pytest.approx(1)


@pytest.mark.parametrize("at_once", [1, 7, 40, 1 << 20])
def test_language_logs_are_added_in_pieces(monkeypatch, at_once):
    monkeypatch.setattr(language, "AT_ONCE", at_once)
    rng = np.random.default_rng(3)
    lengths = np.array([3, 0, 1, 11, 0, 5])
    first = np.concatenate([[0], np.cumsum(lengths)])
    slot, bad = rng.integers(0, 50, first[-1]), rng.random(first[-1]) < 0.2
    logs = rng.normal(size=(50, 3)).astype(np.float32)
    found = np.ones((len(lengths), 3))
    filled = np.flatnonzero(lengths)
    language._add_logs(found, logs, slot, bad, first[:-1][filled], filled)
    for row in range(len(lengths)):
        wanted = np.ones(3)
        for at in range(first[row], first[row + 1]):
            wanted += 0 if bad[at] else logs[slot[at]].astype(float)
        assert found[row] == pytest.approx(wanted)
