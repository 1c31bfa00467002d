"""Every SQL-expressible operator query against DuckDB."""

import pytest

from compare import compare, duck
from conftest import SF_SMALL
from occurlens.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLES[name], SF_SMALL, con)
    assert ok, msg
