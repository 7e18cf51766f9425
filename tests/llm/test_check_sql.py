"""The queries that SQL can express, against DuckDB on the same tables; and what the contract promises of the others."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from cardamom.llm.oracle import all_oracles
from cardamom.llm.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_matches_check_sql(spark, duck, name):
    frame = all_queries()[name](spark, SF_DIR)
    result = duck.execute(all_oracles()[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    got = rows(frame.columns, frame.collect())
    assert got and got == rows(columns, result.fetchall())


def test_contract_lists_every_query():
    names = contract.queries().keys()
    assert {*all_queries(), "pipeline"} <= names
    assert sorted({int(n[2:].split("_")[0]) for n in all_queries()}) == list(range(1, 14))
    assert all_oracles().items() <= contract.oracle_sql().items()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontamination", "packing"]
