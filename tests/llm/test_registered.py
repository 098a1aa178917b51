"""The registered queries: against SQL where there is any, the pipeline stage by stage."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tallyhouse.llm import mixing
from tallyhouse.llm import queries as own
from tallyhouse.llm.oracles import ORACLES
from tallyhouse.llm.storage import stored
from tests.compare import DATA, connect, difference
from tests.llm import cases

FOLDER = str(DATA / "sf0.001")


def test_registration():
    names = set(own.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)}
    assert names | {"pipeline"} <= set(queries()) and set(ORACLES) <= names and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    problem, n = difference(spark, connect(FOLDER), own.queries()[name], ORACLES[name], FOLDER)
    assert problem is None and n > 0


def test_stages_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        rows = [tuple(r) for r in docs.collect()]
        found = stored(stage(spark, docs, FOLDER))
        got = [r.asDict() for r in found.collect()]
        ids = [r["doc_id"] for r in got]
        assert {r["doc_id"] for r in got} <= {r[0] for r in rows}
        if name == "near_duplicates":
            root = cases.components(rows, 5, 80)
            assert sorted(ids) == sorted(i for i, r in root.items() if i == r)
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
            assert sorted(ids) == sorted(r[0] for r in cases.contamination(rows, items) if not r[-1])
        if name == "mixing":
            copies = {r.doc_id: r.copies if r["size"] else 1 for r in mixing.mix(docs).collect()}
            assert sorted(ids) == sorted(i for i, n in copies.items() for _ in range(n))
        if name == "sharding":
            assert found.columns == [*columns, "slot", "shard"] and len(got) == len(rows)
        else:
            assert found.columns == columns
        docs, before = found, rows
    assert before
