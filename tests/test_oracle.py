"""Every query with oracle SQL matches DuckDB on the smallest tables."""

import pytest

from conftest import SF_SMALL
from clickfeat.plans.registry import ORACLE, load_all

load_all()


@pytest.fixture(scope="module")
def con():
    from tools_oracle_check import duck
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    from tools_oracle_check import compare
    ok, msg = compare(spark, con, name, SF_SMALL)
    assert ok, msg
