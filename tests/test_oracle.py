"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck
from strata.plans.oracle import ORACLE
from strata.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, name, QUERIES[name], ORACLE.get(name), SF_DIR, con)
    assert result["status"] in ("ok", "rows-only"), result


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["race_year", "constructor_id", "constructor_name", "total_points",
                          "wins", "podiums", "season_rank"]
    assert df.count() > 0
