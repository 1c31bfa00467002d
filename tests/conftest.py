import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from occurlens.session import get_session

    return get_session("local[*]", "occurlens-tests", {"spark.sql.shuffle.partitions": "8"})


@pytest.fixture(scope="session")
def raw_small(spark):
    from occurlens.sources.fixture import raw_from_tables

    return raw_from_tables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def clean_small(spark, raw_small):
    from occurlens.operators.clean import clean

    return clean(raw_small).checkpoint(eager=True)
