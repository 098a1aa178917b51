import pytest

from tallyhouse.operators import quality as q


@pytest.fixture
def good(table):
    return table("k string, c string, n bigint", [("a", "ca", 1), ("a", "us", 2)])


@pytest.fixture
def bad(table):
    return table("k string, c string, n bigint", [("a", "ca", 1), ("a", "ca", 2), (None, "us", 3)])


RULES = [q.MinRows(1), *q.key_rules("k", "c")]


def verdicts(report):
    return {r.rule: (r.failed_rows, r.success) for r in report.collect()}


def test_passing_table(good):
    assert verdicts(q.validate(good, RULES, "t")) == {
        "min_rows(1)": (0, True),
        "not_null(k)": (0, True),
        "not_null(c)": (0, True),
        "unique(k,c)": (0, True),
    }


def test_failing_rows_are_counted(bad):
    found = verdicts(q.validate(bad, RULES, "t"))
    assert found["not_null(k)"] == (1, False)
    assert found["unique(k,c)"] == (2, False)


def test_empty_table_fails_its_row_count_only(bad):
    found = verdicts(q.validate(bad.limit(0), RULES, "t"))
    assert found["min_rows(1)"] == (1, False)
    assert all(ok for rule, (_, ok) in found.items() if rule != "min_rows(1)")


def test_rows_without_any_key_are_not_duplicates(table):
    df = table("k string, c string", [(None, None), (None, None)])
    assert verdicts(q.validate(df, [q.Unique(("k", "c"))], "t")) == {"unique(k,c)": (0, True)}


def test_types(good):
    found = verdicts(q.validate(good, [q.HasType("n", "bigint"), q.HasType("k", "int")], "t"))
    assert found == {"has_type(n,bigint)": (0, True), "has_type(k,int)": (2, False)}


def test_all_failures_are_collected_and_missing_tables_skipped(good, bad):
    suites = {name: RULES for name in ("gold_a", "gold_b", "gold_c", "gold_d")}
    tables = {"gold_a": bad, "gold_b": good, "gold_c": bad.limit(0), "gold_d": None}
    with pytest.raises(q.QualityError, match="gold_a, gold_c$"):
        q.assert_all(q.validate_all(tables, suites))
    q.assert_all(q.validate_all({"gold_b": good}, suites))


def test_foreign_key_allows_null(table):
    child = table("id int, ref int", [(1, 10), (2, 11), (3, 11), (4, None)])
    parent = table("pk int", [(10,)])
    assert verdicts(q.foreign_key(child, "ref", parent, "pk", "child")) == {
        "references(ref)": (2, False)
    }
