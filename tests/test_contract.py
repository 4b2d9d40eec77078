"""Every registered query beside its SQL on the smallest tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as contract
from millrace.catalog import all_oracles, all_queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)

    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_contract_has_all_queries():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"domain", "split", "n_rows"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(ORACLES[name])
    theirs = canonical([c[0] for c in result.description], result.fetchall())
    assert mine == theirs
