"""Every registered query against its SQL in another engine."""

import oracle
import pytest

import __spark_entry__ as entry
from workloads.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connection(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, folder, con, name):
    result = entry.queries()[name](spark, folder).toArrow()
    assert result.num_rows > 0
    if name in ORACLES:
        expected = con.sql(ORACLES[name]).to_arrow_table()
        assert oracle.differences(result, expected) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).columns[-1] == "tier"
