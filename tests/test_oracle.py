"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from riskpanel.catalog import oracle_sql  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    from check_oracle import duck
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    from check_oracle import compare
    ok, n, _, _, detail = compare(spark, con, SF, name, oracle_sql()[name])
    assert ok, detail
