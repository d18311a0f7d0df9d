"""Every registered query outside the training-text subpackage against its SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from cairnflow.plans import registry
from cairnflow.session import TABLES

SF = "/root/testdata/sf0.001"
#: Queries whose result is empty on the given tables (others of the same operator have rows), and one that is on the smallest.
EMPTY = {"ref_field_search", "ref_missing_from", "ref_contains_any"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def normal(columns, rows):
    def cell(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, (int, float)):
            return repr(round(float(v), 9) + 0.0)
        return str(getattr(v, "replace", lambda **_: v)(tzinfo=None)) if hasattr(v, "tzinfo") else str(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name not in registry.ORACLES:
        assert rows
        return
    want = duck.execute(registry.ORACLES[name])
    assert rows or name in EMPTY
    assert normal(got.columns, rows) == normal([d[0] for d in want.description], want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
