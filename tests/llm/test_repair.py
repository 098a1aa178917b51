"""Repair of conversations: against all sequences of edits on short ones."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def least(symbols: list[tuple[str, str]]) -> tuple[int, str, tuple]:
    """(cost, audit, edits) over all sequences of edits; symbols are (initial, fault)."""
    grammar = re.compile(r"(s?(ua)+)?")

    @lru_cache(None)
    def rest(i: int, written: str, inserted: int):
        options = []
        if i == len(symbols) and grammar.fullmatch(written):
            options.append((0, "", ()))
        if not any(grammar.fullmatch(written + x) for x in ("", "a", "ua")):
            return (10**6, "", ())
        tail = {"u": "u", "a": "ua"}.get(written[-1:], written)  # what may follow depends on no more
        if i < len(symbols):
            initial, fault = symbols[i]
            more = 3 if fault == "truncated" else 0
            steps = [(4, "D", "", tail)]
            if fault not in ("blank", "duplicate"):
                steps += [(more, "K", initial, tail + initial)] if len(initial) == 1 else []
                steps += [(3 + more, "R", x, tail + x) for x in "ua"]
            for cost, edit, role, then in steps:
                c, a, e = rest(i + 1, then, 0)
                options.append((cost + c, edit + a, ((edit, role), *e)))
        if inserted < 3:
            for x in "ua":
                c, a, e = rest(i, tail + x, inserted + 1)
                options.append((3 + c, "I" + a, (("I", x), *e)))
        return min(options, default=(10**6, "", ()))

    return rest(0, "", 0)


def expected(rows):
    out = {}
    null_first = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())
    left = damage(rows)
    for conv_id in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv_id), key=null_first)
        seen, symbols, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in own:
            end = text.rstrip(BLANK)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated"
            seen.add((role, text))
            symbols.append((role[:1], fault))
            if fault:
                counts[fault] += 1
        cost, audit, edits = least(symbols)
        said, i = [], 0
        for edit, role in edits:
            name = {"u": "user", "a": "assistant"}.get(role)
            if edit == "I":
                said.append(f"{name}:")
                continue
            if edit != "D":
                said.append(f"{own[i][2] if edit == 'K' else name}:{own[i][3]}")
            i += 1
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip(symbols, symbols[1:]))
        sha = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out[conv_id] = (gaps, *counts.values(), illegal, cost, audit, sha)
    return out


def table(seed: int, n: int, longest: int = 6):
    r = random.Random(seed)
    texts = ["a.", "b!", "c", "d ?\n", " ", "", "e\t", "same.", "same.", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "uncle"]
    rows = [(i, r.choice([k, k, k, k + 3, None]), r.choice(roles), r.choice(texts)) for i in range(n) for k in range(r.randrange(1, longest))]
    rows += [(n + i, k, "user" if k % 2 == 0 else "assistant", f"t{k}.") for i in range(30) for k in range(2 * (i % 4 + 1))]
    rows += [(None, 0, "user", "x."), (None, 1, "assistant", "y."), (-5, None, None, None)] + rows[:7]
    return rows


def test_all_answers_are_those_of_all_edits(spark):
    rows = table(3, 250)
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("cost", F.lit("x")).withColumn("part", F.lit(1)).repartition(5)
    found = {r.conv_id: tuple(r)[1:9] for r in repair.repair(turns).collect()}
    wanted = expected(rows)
    assert found.keys() == wanted.keys()
    assert [(k, found[k], wanted[k]) for k in wanted if found[k] != wanted[k]] == []


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.sampled_from("usaxuaua"), st.sampled_from(["", "", "", "truncated", "blank"])), max_size=6))
def test_nodes_give_the_least_cost_and_audit(symbols):
    nodes = repair.Nodes()
    for initial, fault in reversed(symbols):
        letter = repair.MUST_GO if fault == "blank" else initial.upper() if fault else initial
        nodes.enter(ord(letter))
    assert nodes.audit() == least([(i, f) for i, f in symbols])[:2]


def test_branches_share_their_nodes():
    nodes, entered = repair.Nodes(), 0
    words = sorted(["uaua"[::-1], "sua"[::-1], "ua"[::-1], "xua"[::-1], "uauA"[::-1]])
    for word in (w.encode() for w in words):
        shared = repair._common(word, nodes.symbols)
        nodes.cut(shared)
        for symbol in word[shared:]:
            nodes.enter(symbol)
            entered += 1
        fresh = repair.Nodes()
        for symbol in word:
            fresh.enter(symbol)
        assert nodes.audit() == fresh.audit()
    assert entered == len({w[:k] for w in words for k in range(1, len(w) + 1)})


def test_a_long_conversation_and_its_rows(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"text {k}.") for k in range(6000)]
    rows += [(2, k, "user", "again.") for k in range(500)]
    turns = spark.createDataFrame(rows, SCHEMA)
    left = repair.damaged(turns)
    found = {r.conv_id: r for r in repair.repair(turns).collect()}
    assert len(found[1].audit) >= left.where("conv_id = 1").count()
    assert found[2].duplicate == left.where("conv_id = 2 and text != ''").select("text").count() - left.where(
        "conv_id = 2 and text != ''"
    ).distinct().select("text").distinct().count()
    plans = spark.createDataFrame([(r.conv_id, r.audit) for r in found.values()], "conv_id long, audit string")
    out = repair.repaired(left, plans).orderBy("conv_id", "position").collect()
    for conv_id in (1, 2):
        own = [r for r in out if r.conv_id == conv_id]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in own))
        sha = hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest()
        assert sha == found[conv_id].repaired_sha256


def test_no_rows_and_audits_that_do_not_fit(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair.repair(nothing).count() == 0
    gone = next(i for i in range(10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (r,) = repair.repair(spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA)).collect()
    assert tuple(r) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), "")
    rows = spark.createDataFrame([(1, 0, "user", "a.")], SCHEMA)
    for audit in ("", "KK"):
        with pytest.raises(Exception, match="does not fit|StopIteration"):
            repair.repaired(rows, spark.createDataFrame([(1, audit)], "conv_id long, audit string")).collect()
