"""Every registered query against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import importlib.util
import os

import duckdb
import pytest

from ledgerweave.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_spec = importlib.util.spec_from_file_location("entry", os.path.join(ROOT, "__spark_entry__.py"))
entry = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry)

NAMES = [*QUERIES]  # the training-data queries have tests of their own

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "float": "FLOAT",
    "double": "DOUBLE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        view = name.removesuffix(".parquet")
        connection.execute(f"create view {view} as select * from '{SF}/{name}'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    relation = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    kinds = {c: KINDS.get(k, k.upper()) for c, k in kinds.items()}
    assert kinds == dict(zip(relation.columns, map(str, relation.types)))
    at = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=str)
    found = sorted((tuple(r[c] for c in columns) for r in rows), key=str)
    assert found == expected


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["fiscal_year_quarter_cd", "geography_nm", "row_cnt", "amt"]
    assert df.count() > 0
