"""Every SQL-expressible binding equals its DuckDB oracle at sf0.01."""

import pytest

from chunkwise.plans import ORACLE, QUERIES
from chunkwise.plans.verify import compare, duckdb_connection

from conftest import SF_CHECK


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_CHECK)


def test_every_query_has_a_binding():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    r = compare(spark, key, SF_CHECK, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r
    assert not r["type_mismatch"], r
