"""Toxicity: a bidirectional gated recurrent network with attention pooling over words and characters.

A word is read as the embedding of its hash and the mean embedding of its hashed character grams. A gated
recurrent unit runs over each window in both directions; attention weighs the states; a logistic unit
gives the window's probability. A text's score is the largest of its windows. Windows overlap and cover
the whole text. All of it is numpy: training in one task over a bounded sample, scoring in all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.frames import held_out, in_arrow

WINDOW = 32
STRIDE = 24  # neighbouring windows share WINDOW - STRIDE words
WORD_BITS, WORD_DIM = 18, 8  # 8 MB of embeddings; with fewer slots, harmless words share those of bad ones
GRAM = 5  # bytes of a character gram, the word's border included
GRAM_BITS, GRAM_DIM = 14, 8
HIDDEN = 8
MAX_DOCS = 3_000  # of each label; the first by a hash of doc_id
MAX_WINDOWS = 12  # training windows of a document without the label, spread evenly over it
LEAST_STEPS = 50
DROPPED = 0.3  # part of the words read by their characters only, in training
DOUBT = -3.0  # logit from which on such a document's other windows are trained on, too
THRESHOLD = 0.7
HELD_OUT = (3, 1)  # crc32(doc_id) modulo 3 is 1


@dataclass
class Words:
    """The words of a slice: slots of the words, of their grams, and where each word's grams begin."""

    word: np.ndarray
    gram: np.ndarray
    gram_first: np.ndarray
    first: np.ndarray  # where each text's words begin


def read(data: np.ndarray, bounds: np.ndarray) -> Words:
    data = tx.LOWER[data]
    w = tx.words(data, bounds, tx.ALNUM)
    h = tx.Hashes(data).spans(w.starts, w.ends)
    size = w.ends - w.starts
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(w.starts - first[:-1], size) + np.arange(first[-1])
    begin, end = np.repeat(w.starts, size), np.repeat(w.ends, size)
    code = np.zeros(len(at), np.uint32)
    for step in range(-(GRAM // 2), GRAM // 2 + 1):  # 1 and 2 stand before and after a word
        near = data[np.clip(at + step, 0, max(len(data) - 1, 0))] if len(at) else np.empty(0, np.uint8)
        near = np.where(at + step < begin, 1, np.where(at + step >= end, 2, near)).astype(np.uint32)
        code = (code ^ near) * np.uint32(0x01000193)
        code ^= code >> np.uint32(13)
    gram = (code * np.uint32(0xC2B2AE35)) >> np.uint32(32 - GRAM_BITS)
    return Words((h >> np.uint64(64 - WORD_BITS)).astype(np.int32), gram.astype(np.int32), first, w.first)


def _joined(parts: list[Words]) -> Words:
    """The words of several slices as one; slices are read one by one to keep the arrays between small."""
    word, gram = (np.concatenate([getattr(p, k) for p in parts]) for k in ("word", "gram"))
    size = np.concatenate([np.diff(p.gram_first) for p in parts])
    count = np.concatenate([np.diff(p.first) for p in parts])
    return Words(word, gram, np.concatenate([[0], np.cumsum(size)]), np.concatenate([[0], np.cumsum(count)]))


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every text: its windows' row, first word, and number of words. A text without words has one empty window."""
    size = np.diff(first)
    n = np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(size)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = first[:-1][row] + step * STRIDE
    return row, start, np.minimum(first[1:][row] - start, WINDOW)


@dataclass(frozen=True)
class Network:
    word: np.ndarray  # embeddings
    gram: np.ndarray
    inputs: np.ndarray  # word and gram vector -> gates of both directions: update, reset, candidate
    bias: np.ndarray
    forward: np.ndarray  # state -> gates
    backward: np.ndarray
    attend: np.ndarray  # states -> hidden layer of the attention
    attend_out: np.ndarray
    out: np.ndarray  # pooled state -> logit, with the bias last

    def names(self) -> list[str]:
        return list(self.__dataclass_fields__)


def fresh(seed: int = 11) -> Network:
    r = np.random.default_rng(seed)
    x, h = WORD_DIM + GRAM_DIM, HIDDEN
    normal = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
    return Network(
        normal(1 << WORD_BITS, WORD_DIM, scale=0.02),  # a word never seen says almost nothing
        normal(1 << GRAM_BITS, GRAM_DIM, scale=0.02),
        normal(x, 6 * h, scale=x**-0.5),
        np.zeros(6 * h, np.float32),
        normal(h, 3 * h, scale=h**-0.5),
        normal(h, 3 * h, scale=h**-0.5),
        normal(2 * h, 2 * h, scale=(2 * h) ** -0.5),
        normal(2 * h, scale=(2 * h) ** -0.5),
        np.concatenate([normal(2 * h, scale=(2 * h) ** -0.5), np.zeros(1, np.float32)]),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _vectors(net: Network, words: Words) -> np.ndarray:
    """The input vector of each word."""
    sums = np.zeros((len(words.gram) + 1, GRAM_DIM), np.float64)
    np.cumsum(net.gram[words.gram], axis=0, dtype=np.float64, out=sums[1:])
    size = np.maximum(np.diff(words.gram_first), 1)
    mean = (sums[words.gram_first[1:]] - sums[words.gram_first[:-1]]) / size[:, None]
    return np.concatenate([net.word[words.word], mean.astype(np.float32)], axis=1)


def _run(gates: np.ndarray, recur: np.ndarray, there: np.ndarray, order, keep: bool):
    """One direction. gates: (window, step, 3H); there: (window, step). A missing word leaves the state."""
    n, h = gates.shape[0], HIDDEN
    state = np.zeros((n, h), np.float32)
    states = np.empty((n, gates.shape[1], h), np.float32)
    trace = {}
    for t in order:
        a = gates[:, t]
        b = state @ recur
        zr = _sigmoid(a[:, : 2 * h] + b[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        c = np.tanh(a[:, 2 * h :] + r * b[:, 2 * h :])
        m = there[:, t, None]
        new = state + m * z * (c - state)
        if keep:
            trace[t] = (state, z, r, c, b[:, 2 * h :], m)
        states[:, t] = state = new
    return states, trace


def _pool(net: Network, states: np.ndarray, there: np.ndarray):
    u = np.tanh(states @ net.attend)
    e = u @ net.attend_out
    e = np.where(there > 0, e, -1e9)
    e = np.exp(e - e.max(axis=1, keepdims=True)) * there
    weight = e / np.maximum(e.sum(axis=1, keepdims=True), 1e-9)
    pooled = (weight[:, :, None] * states).sum(axis=1)
    return u, weight, pooled, pooled @ net.out[:-1] + net.out[-1]


def logits(net: Network, words: Words, start: np.ndarray, size: np.ndarray, most: int = 2048) -> np.ndarray:
    """The logit of each window, ``most`` windows at a time; windows come in the order of the text."""
    out = np.empty(len(start))
    steps = np.arange(WINDOW)
    for a in range(0, len(start), most):
        s, n = start[a : a + most], size[a : a + most]
        low, high = int(s.min()), int((s + n).max())
        part = _subset(words, np.arange(low, high))
        gates = _vectors(net, part) @ net.inputs + net.bias
        gates = np.concatenate([gates, np.zeros((1, 6 * HIDDEN), gates.dtype)])
        there = (steps[None, :] < n[:, None]).astype(np.float32)
        g = gates[np.where(there > 0, s[:, None] - low + steps, len(gates) - 1)]
        ahead, _ = _run(g[:, :, : 3 * HIDDEN], net.forward, there, range(WINDOW), False)
        back, _ = _run(g[:, :, 3 * HIDDEN :], net.backward, there, range(WINDOW - 1, -1, -1), False)
        out[a : a + most] = _pool(net, np.concatenate([ahead, back], axis=2), there)[3]
    return out


def _run_back(grad: np.ndarray, trace: dict, recur: np.ndarray, order):
    """Gradients of one direction: of the gates' inputs and of the recurrent weights."""
    n, steps, h = grad.shape
    d_gates = np.empty((n, steps, 3 * h), np.float32)
    d_recur = np.zeros_like(recur)
    d_state = np.zeros((n, h), np.float32)
    for t in order:
        state, z, r, c, b, m = trace[t]
        d = d_state + grad[:, t]
        dz = d * m * (c - state) * z * (1 - z)
        dc = d * m * z * (1 - c * c)
        dr = dc * b * r * (1 - r)
        d_gates[:, t] = np.concatenate([dz, dr, dc], axis=1)
        into = np.concatenate([dz, dr, dc * r], axis=1)
        d_recur += state.T @ into
        d_state = d * (1 - m * z) + into @ recur.T
    return d_gates, d_recur


def gradients(net: Network, words: Words, start: np.ndarray, size: np.ndarray, label: np.ndarray, heard=None):
    """(loss, gradients, slots) of the mean cross-entropy over some windows.

    The gradient of the word embeddings is given for the rows in slots only; no other word is there.
    heard, if given, is a function from a number of words to a factor of each word's embedding.
    """
    h, steps = HIDDEN, np.arange(WINDOW)
    there = (steps[None, :] < size[:, None]).astype(np.float32)
    at = np.where(there > 0, start[:, None] + steps, 0)
    used, place = np.unique(at, return_inverse=True)
    place = place.reshape(at.shape)
    part = _subset(words, used)
    x = _vectors(net, part)
    factor = np.ones((len(used), 1), np.float32) if heard is None else heard(len(used))[:, None]
    x[:, :WORD_DIM] *= factor
    g = (x @ net.inputs + net.bias)[place]
    ahead, trace_a = _run(g[:, :, : 3 * h], net.forward, there, range(WINDOW), True)
    back, trace_b = _run(g[:, :, 3 * h :], net.backward, there, range(WINDOW - 1, -1, -1), True)
    states = np.concatenate([ahead, back], axis=2)
    u, weight, pooled, logit = _pool(net, states, there)
    p = _sigmoid(logit)
    loss = -np.mean(np.log(np.maximum(np.where(label == 1, p, 1 - p), 1e-7)))
    d_logit = ((p - label) / len(label)).astype(np.float32)
    d_pooled = d_logit[:, None] * net.out[:-1]
    d_weight = (states * d_pooled[:, None, :]).sum(axis=2)
    d_e = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
    d_u = d_e[:, :, None] * net.attend_out * (1 - u * u)
    d_states = weight[:, :, None] * d_pooled[:, None, :] + d_u @ net.attend.T
    da, d_forward = _run_back(d_states[:, :, :h], trace_a, net.forward, range(WINDOW - 1, -1, -1))
    db, d_backward = _run_back(d_states[:, :, h:], trace_b, net.backward, range(WINDOW))
    d_g = (np.concatenate([da, db], axis=2) * there[:, :, None]).reshape(-1, 6 * h)
    d_word_gates = np.zeros((len(used), 6 * h), np.float32)
    np.add.at(d_word_gates, place.ravel(), d_g)
    d_x = d_word_gates @ net.inputs.T
    slots, own = np.unique(part.word, return_inverse=True)
    d_word = np.zeros((len(slots), WORD_DIM), net.word.dtype)
    np.add.at(d_word, own, d_x[:, :WORD_DIM] * factor)
    grams = np.diff(part.gram_first)
    d_gram = np.zeros_like(net.gram)
    np.add.at(d_gram, part.gram, np.repeat(d_x[:, WORD_DIM:] / np.maximum(grams, 1)[:, None], grams, axis=0))
    flat = states.reshape(-1, 2 * h)
    found = Network(
        d_word, d_gram, x.T @ d_word_gates, d_word_gates.sum(axis=0), d_forward, d_backward,
        flat.T @ d_u.reshape(-1, 2 * h), (d_e[:, :, None] * u).sum(axis=(0, 1)),
        np.concatenate([pooled.T @ d_logit, [d_logit.sum()]]).astype(np.float32),
    )
    return loss, found, slots


def _subset(words: Words, at: np.ndarray) -> Words:
    size = words.gram_first[at + 1] - words.gram_first[at]
    first = np.concatenate([[0], np.cumsum(size)])
    place = np.repeat(words.gram_first[at] - first[:-1], size) + np.arange(first[-1])
    return Words(words.word[at], words.gram[place], first, np.array([0, len(at)]))


def _descend(net: Network, words: Words, start, size, label, epochs: int, rate: float, batch: int, seed: int) -> Network:
    """Adam over shuffled batches, epochs times over all windows and LEAST_STEPS steps an epoch at least.

    The steps of the embeddings are damped: a word that few windows hold moves little, so that rare words
    are not learned by heart. Only the rows of words in the batch are touched.
    """
    net = replace(net, word=net.word.copy())
    r = np.random.default_rng(seed)
    mean = {k: np.zeros_like(getattr(net, k)) for k in net.names()}
    square = {k: np.zeros_like(getattr(net, k)) for k in net.names()}
    damping = {"word": 3e-4, "gram": 3e-4}
    heard = lambda n: (r.random(n) >= DROPPED).astype(np.float32) / (1 - DROPPED)
    step = 0
    for _ in range(epochs):
        times = max(1, -(-LEAST_STEPS * batch // len(start)))
        order = np.concatenate([r.permutation(len(start)) for _ in range(times)])
        for a in range(0, len(order), batch):
            own = order[a : a + batch]
            _, grad, slots = gradients(net, words, start[own], size[own], label[own], heard)
            step += 1
            moved = {}
            for k in net.names():
                at = slots if k == "word" else slice(None)
                g = getattr(grad, k)
                mean[k][at] += 0.1 * (g - mean[k][at])
                square[k][at] += 0.01 * (g * g - square[k][at])
                towards = mean[k][at] / (1 - 0.9**step)
                towards /= np.sqrt(square[k][at] / (1 - 0.99**step)) + damping.get(k, 1e-6)
                value = (getattr(net, k)[at] - rate * towards).astype(np.float32)
                if k == "word":
                    net.word[at] = value
                else:
                    moved[k] = value
            net = replace(net, **moved)
    return net


def _word_evidence(words: Words, label: np.ndarray) -> np.ndarray:
    """For each word: how much more often its slot is in texts with label 1, as a smoothed logarithm."""
    text = np.repeat(np.arange(len(label)), np.diff(words.first))
    pairs = np.unique((text << WORD_BITS) | words.word)
    held = [np.bincount(own & ((1 << WORD_BITS) - 1), minlength=1 << WORD_BITS)
            for own in (pairs[label[pairs >> WORD_BITS] == y] for y in (0, 1))]
    expected = held[0] * (label == 1).sum() / max((label == 0).sum(), 1)
    return np.log((held[1] + 1) / (expected + 1))[words.word]


def train(words: Words, label: np.ndarray, prior: float = 0.0, seed: int = 11) -> Network:
    """Fit on texts of which only the whole is labelled.

    prior is the logarithm of how much rarer label 1 is in these texts than where they were drawn from, given
    as odds; it goes to the bias, so that scores are probabilities there and not in the sample.

    Of a text with label 1 one cannot know which windows earn it. At first those are taken as examples
    that hold its most telling word, then those that the network itself scores highest or above one half;
    its other windows are left out. Of texts with label 0, MAX_WINDOWS windows at most are examples,
    and in the second turn all that the network is in doubt about.
    """
    net = fresh(seed)
    row, start, size = windows(words.first)
    count = np.bincount(row, minlength=len(label))
    step = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    every = np.maximum(1, -(-count // MAX_WINDOWS))[row]
    spread = step % every == 0
    y = label[row].astype(np.float32)
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        bias = np.concatenate([np.zeros(2 * HIDDEN), [np.log(rate / (1 - rate))]])
        return replace(net, out=bias.astype(np.float32))
    evidence = np.append(_word_evidence(words, label), -np.inf)
    at = np.where(np.arange(WINDOW) < size[:, None], start[:, None] + np.arange(WINDOW), len(evidence) - 1)
    z = evidence[at].max(axis=1)
    for again, epochs in enumerate((3, 1, 1)):
        best = np.full(len(label), -np.inf)
        np.maximum.at(best, row, z)
        telling = (z >= best[row]) | ((z > 0) & (again > 0))
        clear = np.where(y == 1, telling, spread | ((z > DOUBT) & (again > 0)))
        net = _descend(net, words, start[clear], size[clear], y[clear], epochs, 0.01, 256, seed + again)
        z = logits(net, words, start, size)
    best = np.full(len(label), -np.inf)
    np.maximum.at(best, row, z)
    a, b = _calibration(best, label)
    return replace(net, out=np.append(a * net.out[:-1], a * net.out[-1] + b + prior).astype(np.float32))


def _prior(label: np.ndarray, labelled: dict[int, int]) -> float:
    """Log of the odds of label 1 among all labelled rows, over those in the sample; 0 without two labels."""
    held = {y: int((label == y).sum()) for y in (0, 1)}
    if not all(held.values()):
        return 0.0
    drawn = {y: held[y] / max(labelled.get(y, 0), held[y]) for y in held}
    return float(np.log(drawn[0] / drawn[1]))


def _calibration(best: np.ndarray, label: np.ndarray, turns: int = 30) -> tuple[float, float]:
    """Logistic regression of a text's label on the largest logit of its windows (Newton steps, slope above 0)."""
    x = np.stack([np.clip(best, -12, 12), np.ones(len(best))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(turns):
        p = _sigmoid(x @ w)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        w = w - np.linalg.solve(curve, x.T @ (p - label) + 0.1 * (w - [1.0, 0.0]))
    return max(float(w[0]), 0.1), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Network:
    """Fit on labelled rows that are not held out, max_docs of each label at most.

    labels has doc_id and label; null labels are left out, of repeated ones the largest counts. Without
    two labels the network gives every text the same score. The share of each label is counted over all
    of these rows, so scores do not depend on how many of them max_docs leaves.
    """
    known = labels.where(F.col("label").isNotNull() & ~held_out(F.col("doc_id"), *HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    by_hash = lambda rows: rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    sample = by_hash(known.where("label = 1")).union(by_hash(known.where("label = 0")))
    rows_of = docs.groupBy("doc_id").agg(F.count("*").alias("n")).join(known.where("label IN (0, 1)"), "doc_id")
    labelled = {r.label: r.n for r in rows_of.groupBy("label").agg(F.sum("n").alias("n")).collect()}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        parts = [read(p.data, p.bounds) for batch in held for p in tx.slices(batch.column("text"))]
        label = np.concatenate([batch.column("label").to_numpy() for batch in held])
        net = train(_joined(parts), label, _prior(label, labelled))
        yield pa.RecordBatch.from_pydict({k: [getattr(net, k).tobytes()] for k in net.names()})

    # 2 * max_docs pairs of numbers are broadcast; the bounded sample is read by one task
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * max_docs).select("label", "text")
    empty = fresh()
    found = rows.mapInArrow(learn, ", ".join(f"{k} binary" for k in empty.names())).collect()
    if not found:
        return train(read(np.empty(0, np.uint8), np.zeros(1, np.int64)), np.empty(0, np.int64))
    return Network(*[np.frombuffer(found[0][k], np.float32).reshape(getattr(empty, k).shape) for k in empty.names()])


def _scores(net: Network, part: tx.Slice) -> np.ndarray:
    words = read(part.data, part.bounds)
    row, start, size = windows(words.first)
    best = np.full(part.rows, -np.inf)
    np.maximum.at(best, row, logits(net, words, start, size))
    return _sigmoid(best)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score (0 to 1) of every row of docs; null and empty texts get that of an empty window."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def work(batch: pa.RecordBatch) -> pa.Table:
        out = [_scores(shared.value, part) for part in tx.slices(batch.column("text"))]
        return pa.table({"doc_id": batch.column("doc_id"), "score": np.concatenate(out)})

    return in_arrow(docs.select("doc_id", "text"), work, "doc_id long, score double")


def predicted(threshold: float = THRESHOLD) -> Column:
    return (F.col("score") >= threshold).cast("int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs. Repeated rows are scored each."""
    mark = held_out(F.col("doc_id"), *HELD_OUT).alias("held_out")
    return score(docs, fit(docs, labels)).select("doc_id", mark, "score", predicted().alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score below the threshold, all columns kept; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def work(batch: pa.RecordBatch) -> pa.Table:
        out = [_scores(shared.value, part) for part in tx.slices(batch.column("text"))]
        return pa.Table.from_batches([batch.filter(pa.array(np.concatenate(out) < threshold))])

    return in_arrow(docs, work, docs.schema)
