"""Queries of the subpackage that have SQL, against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from temblor.llm.registry import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


def _value(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df, oracle = QUERIES[name](spark, FOLDER), duck.sql(ORACLE_SQL[name])
    columns = sorted(oracle.columns)
    assert sorted(df.columns) == columns
    place = [oracle.columns.index(c) for c in columns]
    want = [tuple(_value(r[k]) for k in place) for r in oracle.fetchall()]
    got = [tuple(map(_value, r)) for r in df.select(columns).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_all_are_registered():
    names = set(contract.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
