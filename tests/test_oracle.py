"""Every registered query against its DuckDB oracle (order-insensitive)."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from conftest import SF_SMALL
from occurlens.plans.queries import REGISTRY

SQL = {name: sql for name, (_, sql) in REGISTRY.items()}
QUERIES = {name: fn for name, (fn, _) in REGISTRY.items()}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert all(SQL.values())


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), SQL[name], SF_SMALL, con)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["ano", "tipo_crime", "total", "variacao_yoy_pct"]
    assert df.count() > 0
