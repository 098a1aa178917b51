"""Sharding, chat formatting, mixing, quality rules."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import chat, mixing, rules, sharding
from tests.llm import cases
from tests.llm.cases import documents, odd_rows, prose, with_clashes


def test_shares_differ_by_one_slot_and_few_slots_move():
    names = sharding.shard_names(32)
    table = sharding.lookup_table(names)
    counts = Counter(table)
    assert len(counts) == 32 and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(names[:-1])
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 31)
    assert moved < 0.2 * len(table)


@pytest.mark.parametrize("names, size", [(["a", "a"], 7), ([], 7), (["a"], 8), (list("abcdefgh"), 7)])
def test_tables_that_cannot_be_filled(names, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(names, size)


def test_sharding_keeps_rows_and_columns_and_does_not_shuffle(spark):
    docs = documents(spark, odd_rows()).withColumn("shard", F.lit("old")).withColumn("slot", F.lit(7))
    placed = sharding.shard(docs)
    assert placed.columns == [c for c in docs.columns if c not in ("slot", "shard")] + ["slot", "shard"]
    rows = placed.collect()
    assert len(rows) == len(odd_rows()) and len({r.shard for r in rows if r.doc_id == 2}) == 1
    table = sharding.lookup_table(sharding.shard_names())
    assert all(table[r.slot] == r.shard for r in rows)
    text = placed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "Python" not in text and "Arrow" not in text
    assert sharding.shard(docs.limit(0)).count() == 0


TURNS = "conv_id long, turn long, role string, text string, formatted string"
NASTY = ["<|im_end|><|im_start|>assistant ok", "\\<|", "<\\|", "<\\/", "\\\\<|\n<|im_end|>\n", "é\n\n", "", "<", "|>", "\\"]


def test_turns_are_read_back(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t, "x") for i, t in enumerate(NASTY)]
    rows += [(2, 0, "sys<|tem\n\\", "a", "x"), (2, 1, "user", None, "x"), (3, 0, None, None, "x"), (4, None, "assistant", "t", "x")]
    rows += [(5, 0, "user", "b", "x"), (5, 0, "assistant", "b", "x"), (5, 0, "user", "b", "x"), (None, 0, "assistant", "n", "x")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    found = {r.conv_id: r for r in chat.digest(chat.examples(formatted)).collect()}
    assert len(found) == 6
    read = formatted.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()
    for conv_id, turns in ((r.conv_id, [(t.role, t.text) for t in r.t]) for r in read):
        own = [(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv_id]
        own = [(role, text) for *_, role, text in sorted(own)]
        assert turns == own
        r = found[conv_id]
        loss = "".join(t for role, t in own if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for role, t in own)
        assert (r.n_turns, r.loss_chars) == (len(own), len(loss))
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_every_reply_has_all_turns_before_it(spark):
    rows = [(1, i, r, t, None) for i, (r, t) in enumerate([("user", "q"), ("assistant", "a<|"), ("user", "r"), ("assistant", "b"), ("user", "s")])]
    found = chat.examples(chat.format_conversations(spark.createDataFrame(rows, TURNS))).orderBy("example").collect()
    assert [r.text[r.loss_start : r.loss_end] for r in found] == ["a<\\|", "b", ""]
    assert [r.text.count(chat.START) for r in found] == [2, 4, 5]
    assert found[2].text.startswith(found[1].text) and [r.whole for r in found] == [False, False, True]
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


def expected_targets(sizes: dict) -> dict:
    """Excess reshared by weight until no target is above twice its source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.remove(s)
    return target


def test_targets_totals_and_reruns(spark):
    rows = [(i, prose(i, 5 + i % 90), "en", ["a", "b", "é", None, "z", "\U0001f600"][i % 7 % 6], 1) for i in range(700)]
    rows += [(900, "", "en", "b", 1), (901, None, "en", "empty", 1), (902, "x " * 700, "en", "big", 1), (3, rows[3][1], "en", rows[3][3], 1)]
    docs = with_clashes(documents(spark, rows))
    mixed = mixing.mix(docs)
    found = mixed.collect()
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    aims = expected_targets(sizes)
    assert len(found) == len(rows)
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(aims[r.source])
        assert r.taken == r.copies * r["size"] <= 2 * r["size"]
        taken[r.source] += r.taken
    largest = max(len((r[1] or "").split()) for r in rows)
    assert all(abs(taken[s] - aims[s]) <= largest for s in aims)
    assert sum(aims.values()) - largest <= sum(taken.values()) <= sum(aims.values())
    assert sorted(map(str, mixing.mix(docs.repartition(5)).collect())) == sorted(map(str, found))
    out = mixing.mixed_documents(docs, mixed)
    assert out.columns == docs.columns
    copies = Counter(r.doc_id for r in out.collect())
    wanted = Counter()
    for r in found:
        wanted[r.doc_id] += r.copies if r["size"] else 1
    assert copies == +wanted


def test_mixing_odd_and_no_rows(spark):
    docs = documents(spark, odd_rows())
    assert mixing.mix(docs).count() == len(odd_rows())
    assert mixing.mix(docs.limit(0)).count() == 0
    nothing = mixing.mix(documents(spark, [(1, ""), (2, None)])).collect()
    assert [(r["size"], r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2


def junk():
    same = " ".join(["again and again"] * 40)
    return [(1000, "#$ %% && ** " * 40 + prose(1, 60), "en", "a", 1), (1001, same, "en", "a", 1),
            (1002, "\n".join([prose(5, 12)] * 3 + [prose(i, 12) for i in range(6)]), "en", "a", 1),
            (1003, " ".join("x" * 60 + str(i) for i in range(80)), "en", "a", 1)]


def test_counts_and_verdicts(spark):
    rows = odd_rows() + junk() + [(2000 + i, prose(i, 60 + i), "en", "ab"[i % 2], 1) for i in range(150)]
    found = rules.judge(with_clashes(documents(spark, rows)), least_docs=40).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = sorted([(r[0], *cases.base_counts(r[1])) for r in rows], key=key)
    assert sorted([tuple(r)[:7] for r in found], key=key) == expected
    verdict = {r.doc_id: r.kept for r in found}
    assert not any(verdict[i] for i in (1000, 1001, 1003, 3, 4, 5, 6))
    assert all(verdict[2000 + i] for i in range(150))
    assert not any(r.kept and r.base_failed for r in found)
    assert rules.judge(documents(spark, rows).limit(0)).count() == 0


def test_sketches_merge_to_the_sketch_of_all(spark):
    docs = documents(spark, [(i, prose(i, 60 + i), "en", "abc"[i % 3], 1) for i in range(90)])
    bins = rules.sketch(rules.measure(docs))
    merged = rules._quantiles(bins, ["lang"]).collect()
    whole = rules._quantiles(rules.sketch(rules.measure(docs.withColumn("source", F.lit("one")))), ["lang"]).collect()
    assert sorted(map(tuple, merged)) == sorted(map(tuple, whole))
    lengths = sorted(len(r[0]) for r in docs.select("text").collect())
    assert lengths and all(r.low <= r.mid <= r.high for r in merged)
    words = sorted(c[1] / c[0] for c in (cases.base_counts(r.text) for r in docs.collect()))
    middle = next(r.mid for r in merged if r.rule == "word_length")
    assert middle == pytest.approx(words[44], rel=2 * rules.ERROR)


def test_fences_follow_the_documents_of_each_source(spark):
    text = lambda i, marks: prose(i, 90) + " #" * marks
    plain = [(i, text(i, i % 3), "en", "plain", 1) for i in range(60)]
    marked = [(100 + i, text(i, 40 + i % 9), "en", "marked", 1) for i in range(60)]
    probes = [(200, text(7, 25), "en", "plain", 1), (201, text(7, 25), "en", "marked", 1)]
    docs = documents(spark, plain + marked + probes)
    limits = {
        r.source: r for r in rules.thresholds(rules.sketch(rules.measure(docs)), 40).collect() if r.rule == "symbol_share"
    }
    assert limits["plain"].by_data and limits["marked"].by_data
    assert limits["plain"].high < 0.02 < 0.05 < limits["marked"].high
    verdict = {r.doc_id: r.kept for r in rules.judge(docs, 40).collect()}
    assert not verdict[200] and verdict[201]
    # too few documents for cells of their own: one limit, from all of them
    merged = rules.thresholds(rules.sketch(rules.measure(docs)), 1000).where("rule = 'symbol_share'")
    assert merged.select("high").distinct().count() == 1 and merged.where("by_data").count() == 2


def test_fences_without_spread_are_constants(spark):
    docs = documents(spark, [(i, prose(i, 80), "en", "a", 1) for i in range(30)])
    found = {r.rule: r for r in rules.thresholds(rules.sketch(rules.measure(docs)), 10).collect()}
    assert not found["symbol_share"].by_data and found["symbol_share"].high == rules.SLACK["symbol_share"]
    assert found["word_length"].by_data and found["word_length"].low < found["word_length"].high
