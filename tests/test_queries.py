"""Every registered query against its SQL, over whole tables."""

import pytest
from conftest import SF_SMALL

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, name, SF_SMALL) == []


def test_every_query_has_sql():
    # the text operators, where they are present, have tests of their own
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry_returns_rows(spark):
    assert entry(spark).columns == ["x", "y", "time", "v"]
    assert entry(spark).limit(1).count() == 1
