import pytest
from pyspark.sql.types import StructField, StructType

from tallyhouse.operators.grouping import seed_if_empty
from tallyhouse.sources import files, jdbc, schemas
from tallyhouse.sources.storage import CommitLog, exists
from tallyhouse.sources.versions import VersionedTables


def test_csv_without_header_and_with_trailing_blanks(spark, tmp_path, rows):
    path = tmp_path / "staff.csv"
    path.write_text("1,Anna,30\n2,Ben,41\n3,Cleo,14   \n")
    found = files.read_csv(spark, str(path), schemas.STAFF, header=False)
    assert rows(found) == [(1, "Anna", 30), (2, "Ben", 41), (3, "Cleo", 14)]


def test_csv_as_text_keeps_bad_values(spark, tmp_path, rows):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,order_date,order_customer_id,order_status,sum\nx,25-07-2013,1,A,\n")
    found = files.read_csv_as_text(spark, str(path), schemas.RAW_ORDERS)
    assert rows(found) == [("x", "25-07-2013", "1", "A", None)]


def test_missing_data_set_is_skipped(spark, tmp_path):
    assert files.read_if_exists(spark, str(tmp_path / "none")) is None


def test_append_and_read(spark, tmp_path, table, rows):
    path = str(tmp_path / "t")
    df = table("a int, b string", [(1, "x")])
    files.append_parquet(df, path, ("b",))
    files.append_parquet(df, path, ("b",))
    assert rows(files.read_if_exists(spark, path)) == [(1, "x"), (1, "x")]
    assert exists(spark, path + "/b=x")


def test_seed_only_when_empty(table, rows):
    seed = table("a int", [(1,)])
    assert rows(seed_if_empty(seed.limit(0), seed)) == [(1,)]
    assert rows(seed_if_empty(table("a int", [(2,)]), seed)) == [(2,)]


def test_table_can_be_replaced_from_itself(spark, tmp_path, table, rows):
    store = VersionedTables(spark, str(tmp_path))
    assert store.read("t") is None
    store.overwrite("t", table("a int", [(1,)]))
    for _ in range(2):
        current = store.read("t")
        store.overwrite("t", current.selectExpr("a + 1 AS a"))
    assert rows(store.read("t")) == [(3,)]
    assert store.state()[0] == 3


def test_old_versions_can_be_dropped(spark, tmp_path, table, rows):
    store = VersionedTables(spark, str(tmp_path))
    assert store.drop_older() == []
    store.overwrite("b", table("a int", [(0,)]))
    for i in range(1, 5):
        store.overwrite("t", table("a int", [(i,)]))
    draft = store.draft()
    draft.write("t", table("a int", [(9,)]))
    dropped = store.drop_older(keep=2)
    assert [d.split("-")[0] for d in dropped] == ["t/version=2", "t/version=3"]
    assert rows(store.read("t")) == [(4,)] and rows(store.read("b")) == [(0,)]
    assert exists(spark, store.path("t", draft.written["t"]["folder"]))


def test_other_tables_keep_their_version(spark, tmp_path, table, rows):
    store = VersionedTables(spark, str(tmp_path))
    store.overwrite("a", table("v int", [(1,)]))
    store.overwrite("b", table("v int", [(2,)]), note="x")
    assert rows(store.read("a")) == [(1,)]
    record = store.state()[1]
    assert {t: e["version"] for t, e in record["tables"].items()} == {"a": 1, "b": 2}
    assert record["note"] == "x"


def test_table_without_rows_keeps_its_columns(spark, tmp_path, table):
    store = VersionedTables(spark, str(tmp_path))
    draft = store.draft()
    draft.write("t", table("a int, c string", []), ["c"])
    draft.commit()
    assert store.read("t").columns == ["a", "c"] and store.read("t").isEmpty()


def test_commit_log(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.latest() == (0, {})
    log.commit(1, {"mark": 5})
    log.commit(2, {"mark": 6, "name": "é"})
    assert log.latest() == (2, {"mark": 6, "name": "é"})
    with pytest.raises(Exception):
        log.commit(2, {"mark": 7})
    assert log.latest()[1]["mark"] == 6


def test_jdbc_options():
    split = jdbc.Split("id", "1", "1000", 10)
    found = jdbc.read_options("jdbc:x:y", jdbc.as_relation("SELECT 1"), {"user": "u"}, split)
    assert found == {
        "url": "jdbc:x:y",
        "dbtable": "(SELECT 1) AS t",
        "user": "u",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "1000",
        "numPartitions": "10",
    }
    assert "numPartitions" not in jdbc.read_options("jdbc:x:y", "t", {})


def test_marks_reach_the_database():
    assert jdbc.rows_query("videos") == jdbc.rows_query("videos", jdbc.Newer("ts", None))
    both = jdbc.Newer("ts", jdbc.utc_text(1), jdbc.utc_text(1_700_000_000_000_000))
    assert jdbc.rows_query("v", both).endswith(
        "WHERE ts > '1970-01-01 00:00:00.000001' AND ts <= '2023-11-14 22:13:20.000000'"
    )
    newer = jdbc.Newer("publish_time", "2017-11-13T17:00:00.000Z' OR 'x")
    expected = "SELECT * FROM videos WHERE publish_time > '2017-11-13T17:00:00.000Z'' OR ''x'"
    assert jdbc.rows_query("videos", newer) == expected


def test_publish_reports_tables_without_data(spark, tmp_path, table, monkeypatch):
    sent = []
    monkeypatch.setattr(jdbc, "write_table", lambda df, url, name, props: sent.append((name, df.count())))
    store = VersionedTables(spark, str(tmp_path))
    store.overwrite("a", table("v int", [(1,)]))
    assert jdbc.publish(store, {"a": "s.a", "b": "s.b"}, "jdbc:x:y", {}) == ["b"]
    assert sent == [("s.a", 1)]


def test_layouts_have_their_keys():
    layouts = {
        "product_lines": schemas.PRODUCT_LINES,
        "products": schemas.PRODUCTS,
        "offices": schemas.OFFICES,
        "employees": schemas.EMPLOYEES,
        "customers": schemas.CUSTOMERS,
        "orders": schemas.ORDERS,
        "payments": schemas.PAYMENTS,
        "order_details": schemas.ORDER_DETAILS,
    }
    for name, key in schemas.PRIMARY_KEYS.items():
        assert all(not layouts[name][c].nullable for c in key)
    for child, column, parent, key in schemas.FOREIGN_KEYS:
        assert layouts[child][column].dataType == layouts[parent][key].dataType
    assert isinstance(schemas.ITEMS, StructType) and isinstance(schemas.ITEMS[0], StructField)


def test_a_reader_asks_for_its_range_only(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(jdbc, "read_table", lambda *a, newer: asked.append((a[2], newer)))
    read = jdbc.ranged_reader(spark, "jdbc:x", "videos", {}, "publish_ts")
    read(None, None), read(5, 1_000_000)
    first, last = "1970-01-01 00:00:00.000005", "1970-01-01 00:00:01.000000"
    assert asked == [("videos", jdbc.Newer("publish_ts", None, None)), ("videos", jdbc.Newer("publish_ts", first, last))]
