"""Every registered query against DuckDB on the same tables: columns, types, rows."""

import math
from collections import Counter

import duckdb
import pytest
from conftest import SF_DIR

from stowage.plans import REGISTERED

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

DUCK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return tuple(v) if isinstance(v, list) else v


def _bag(rows, order):
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query(spark, duck, name):
    df = REGISTERED[name].run(spark, SF_DIR)
    want = duck.sql(REGISTERED[name].check_sql)
    assert sorted(df.columns) == sorted(want.columns)
    types = {c: str(t) for c, t in zip(want.columns, want.types)}
    assert {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in df.schema} == types
    names = sorted(df.columns)
    got = _bag(df.collect(), [df.columns.index(c) for c in names])
    expected = _bag(want.fetchall(), [want.columns.index(c) for c in names])
    assert got == expected
    assert got or name == "table_scan_empty"
