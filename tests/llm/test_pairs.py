"""Near-duplicate links, repeated passages, benchmark passages: against all pairs on small tables."""

import pytest

import tallyhouse.llm.components as components_of
from tallyhouse.llm import decontamination, ngram_join, rules, suffix_dedup
from tallyhouse.llm.components import components
from tests.llm import cases
from tests.llm.cases import documents, edited, odd_rows, prose, with_clashes
from tests.llm.test_text import thue_morse


def near_copies():
    base = prose(50, 400)
    rows = [(100, base)] + [(100 + i, edited(base, i, 0.004 * (i % 9))) for i in range(1, 40)]
    rows += [(200 + i, base) for i in range(15)]
    line = prose(60, 30)
    rows += [(300 + i, f"{line}\n{prose(1000 + i, 50)}") for i in range(25)]
    rows += [(400 + i, f"{line} {line}x{i}") for i in range(12)]
    other = prose(70, 200)
    rows += [(500 + i, other + " " + prose(2000 + i, 6 * i)) for i in range(12)]
    return rows


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("long_list, block", [(64, 1024), (2, 4)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, n, percent, long_list, block):
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies()
    expected = cases.components(rows, n, percent)
    found = ngram_join.join(documents(spark, rows), ngram_join.Grams(n, percent)).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(cases.grams(t, n)) for i, t in rows}


def test_links_between_long_lists_are_not_planned_all_at_once(spark, monkeypatch, capsys):
    monkeypatch.setattr(ngram_join, "LONG_LIST", 2)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    exchanges = []

    def planned(df, stored=ngram_join.stored):
        df.explain()
        exchanges.append(capsys.readouterr().out.count("- Exchange hashpartitioning"))
        return stored(df)

    for module in (ngram_join, components_of):
        monkeypatch.setattr(module, "stored", planned)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ngram_join.join(documents(spark, near_copies()), ngram_join.Grams(5, 80)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(exchanges) <= 20, exchanges


def test_settled_components_take_no_round(spark, monkeypatch):
    made = []
    monkeypatch.setattr(components_of, "stored", lambda df, stored=components_of.stored: made.append(df) or stored(df))
    stars = [(1, 2), (3, 1), (1, 3), (1, 4), (7, 6), (6, 6)]
    found = {tuple(r) for r in components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 1), (6, 6), (7, 6)} and len(made) == 1
    path = [(i, i + 1) for i in range(1, 12)] + [(30, 20), (30, 21), (21, 40), (None, 1)]
    found = {tuple(r) for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {(i, 1) for i in range(1, 13)} | {(i, 20) for i in (20, 21, 30, 40)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows_of_the_join(spark):
    rows = odd_rows()
    docs = with_clashes(documents(spark, rows))
    found = ngram_join.join(docs).collect()
    assert len(found) == len(rows)
    expected = cases.components(rows, 3, 90)
    assert all(r.component_id == expected[r.doc_id] for r in found if r.doc_id is not None)
    assert sorted((r.n_shingles, r.component_id) for r in found if r.doc_id is None and not r.n_shingles) == [(0, None)]
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13, 14]
    assert ngram_join.join(docs.limit(0)).count() == 0


def test_constructed_words_are_told_apart(spark):
    x, y = (t.decode() for t in thue_morse(1024))
    docs = documents(spark, [(1, x), (2, y), (3, f"{x}\n{y}")])
    assert {r.doc_id: r.component_id for r in ngram_join.join(docs).collect()} == {1: 1, 2: 2, 3: 3}
    benchmark = spark.createDataFrame([(9, x)], "item_id long, text string")
    found = decontamination.contamination(docs, benchmark).collect()
    assert {r.doc_id: r.n_hit for r in found} == {1: 1, 2: 0, 3: 1}
    assert {r.doc_id: r.n_dup_lines for r in rules.judge(docs).collect()} == {1: 0, 2: 0, 3: 0}


def test_a_document_with_two_texts_links_both(spark):
    x, y = prose(80, 60), prose(81, 60)
    found = ngram_join.join(documents(spark, [(5, x), (7, x), (7, y), (9, y)])).collect()
    assert {r.component_id for r in found} == {5}


def test_components_of_a_path_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7000, 7001), (7001, 7002), (7002, 7000), (5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, **{7000 + i: 7000 for i in range(3)}}


def passages():
    shared, line = prose(90, 60), prose(91, 12)
    rows = [(i, f"{prose(3000 + i, 40)} {shared} {prose(4000 + i, 30)}") for i in range(20)]
    rows += [(100 + i, f"{prose(5000 + i, 20)}\n{line}\n{line}\n{prose(6000 + i, 20)}") for i in range(20)]
    rows += [(200 + i, prose(92, 80)) for i in range(5)]
    rows += [(300, "Er " * 200), (301, "Er " * 90 + "x" + "Er " * 90), (302, "é" * 130), (303, "a" * 99), (304, "a" * 100), (305, "a" * 101)]
    rows += [(400 + i, edited(prose(93, 120), i, 0.05)) for i in range(20)]
    return rows


@pytest.mark.parametrize("many", [8192, 3])
def test_repeated_bytes_are_those_of_all_strings(spark, monkeypatch, many):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 0.5)
    rows = passages()
    expected = cases.repeated_bytes(rows)
    found = suffix_dedup.digest(documents(spark, rows).repartition(3)).collect()
    assert {r.doc_id: tuple(r[1:]) for r in found} == expected


def test_spans_and_kept_text(spark):
    text = prose(94, 40)
    rows = suffix_dedup.remove(documents(spark, [(1, text), (2, f"x {text} y")])).collect()
    assert [(r.doc_id, r.spans, bytes(r.kept_text)) for r in rows] == [(2, [[2, 2 + len(text.encode())]], b"x  y")]


def test_odd_rows_of_the_removal(spark):
    rows = [r for i, r in enumerate(odd_rows()) if i not in (2, 14)]  # ids once each
    found = suffix_dedup.digest(with_clashes(documents(spark, rows))).collect()
    assert {r.doc_id: tuple(r[1:]) for r in found} == cases.repeated_bytes(rows)
    twice = documents(spark, [(2, prose(1, 60)), (2, prose(1, 60)), (3, prose(1, 60))])
    assert sorted((r.doc_id, r.n_removed > 0) for r in suffix_dedup.digest(twice).collect()) == [(2, False), (2, False), (3, True)]
    assert suffix_dedup.digest(twice.limit(0)).count() == 0


def test_a_text_longer_than_a_slice(spark):
    from tallyhouse.llm import text as tx

    text = " ".join(f"{prose(95, 20)} {prose(8000 + i, 12000, 10**6)}" for i in range(19))
    assert len(text) > 2 * tx.SLICE_BYTES
    rows = [(1, text), (2, prose(95, 18))]
    found = {r.doc_id: tuple(r[1:]) for r in suffix_dedup.digest(documents(spark, rows)).collect()}
    assert found == cases.repeated_bytes(rows)


def items():
    return [
        (1, prose(110, 20)), (2, prose(111, 13)), (3, prose(112, 5)), (4, "Solo"), (5, ""), (6, None),
        (7, prose(110, 20)), (8, "re re re re re re re re re re re re re re re"),
    ]


def holders():
    a, b, c = prose(110, 20), prose(111, 13), prose(112, 5)
    rows = [(1, f"{prose(120, 30)} {a.upper().replace(' ', ', ')} {prose(121, 30)}"), (2, b), (3, f"{c} {prose(122, 300)}")]
    rows += [(4, f"{prose(123, 9)} solo solo"), (5, " ".join(a.split()[:12])), (6, " ".join(a.split()[3:17]) + " " + a)]
    rows += [(7, "re " * 40), (8, "re " * 12), (9, f"{a} {b} {c}"), (10, edited(a, 1, 0.2)), (11, prose(124, 50))]
    return [(*r, "en", "a", 1) for r in rows]


@pytest.mark.parametrize("block_words", [1_000_000, 15])
def test_contamination_is_that_of_all_windows(spark, monkeypatch, block_words):
    find = decontamination.find
    monkeypatch.setattr(decontamination, "find", lambda d, b, w: find(d, b, w, block_words))
    rows = holders() + odd_rows()
    docs = with_clashes(documents(spark, rows))
    benchmark = spark.createDataFrame(items(), "item_id long, text string")
    found = decontamination.contamination(docs, benchmark).drop("text_key")
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(cases.contamination(rows, items()), key=key)


def test_empty_tables_of_the_index(spark):
    docs, benchmark = documents(spark, holders()), spark.createDataFrame(items(), "item_id long, text string")
    assert decontamination.contamination(docs.limit(0), benchmark).count() == 0
    none = decontamination.contamination(docs, benchmark.limit(0)).collect()
    assert len(none) == len(holders()) and not any(r.n_hit or r.contaminated for r in none)
    kept = decontamination.clean(with_clashes(docs), benchmark)
    assert kept.columns == with_clashes(docs).columns
    bad = {r[0] for r in cases.contamination(holders(), items()) if r[-1]}
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in holders()} - bad


def test_proximity(spark):
    import numpy as np

    item = "alpha beta gamma delta"
    docs = documents(spark, [(1, "x beta y z alpha w"), (2, "alpha q r s t u v beta"), (3, "alpha"), (4, "gamma delta")])
    asked = decontamination.tokens(spark.createDataFrame([(1, item)], "item_id long, text string"))
    terms = np.sort(np.array(asked.first().words, np.int64))
    words = asked.first().words
    rare = np.array([[1, 2, 9, 9][words.index(int(t))] for t in terms])
    questions = decontamination.lookups(asked, terms, rare)
    found = decontamination.proximities(decontamination.build_index(docs, terms), questions, slop=3).collect()
    assert [(r.doc_id, r.item_id, r.pos, r.distance) for r in found] == [(1, 1, 4, 3)]


def test_proximity_beyond_the_window(spark):
    import numpy as np

    asked = decontamination.tokens(spark.createDataFrame([(1, "alpha beta")], "item_id long, text string"))
    words = asked.first().words
    terms = np.sort(np.array(words, np.int64))
    questions = decontamination.lookups(asked, terms, np.array([1 + words.index(int(t)) for t in terms]))
    far = documents(spark, [(1, "alpha " + "x " * 14 + "beta"), (2, "beta " + "x " * 20 + "alpha")])
    wide = decontamination.build_index(far, terms, slop=20)
    found = decontamination.proximities(wide, questions, slop=20).collect()
    assert [(r.doc_id, r.pos, r.distance) for r in found] == [(1, 0, 15)]
    with pytest.raises(Exception, match="slop=20"):
        decontamination.proximities(decontamination.build_index(far, terms), questions, slop=20).collect()


def test_many_questions_are_joined_without_a_broadcast(spark):
    import numpy as np

    asked = decontamination.tokens(
        spark.createDataFrame([(1, "one two three four"), (2, "three four five"), (3, "six")], "item_id long, text string")
    )
    terms = decontamination._terms(asked.selectExpr("explode(words) AS term"), "term")
    questions = decontamination.lookups(asked, terms, np.arange(len(terms)))
    texts = ["zero one two three four five", "three four", None, "", "six six", "four five three four five"]
    index = decontamination.build_index(documents(spark, list(enumerate(texts))), terms)
    key = lambda r: (r.doc_id, r.item_id, r.first, r.last)
    few = decontamination.phrases(index, questions, few=100)
    many = decontamination.phrases(index, questions, few=0)
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
    found = sorted(map(key, many.collect()))
    assert found == sorted(map(key, few.collect()))
    assert found == [(0, 1, 1, 4), (0, 2, 3, 5), (4, 3, 0, 0), (4, 3, 1, 1), (5, 2, 2, 4)]
