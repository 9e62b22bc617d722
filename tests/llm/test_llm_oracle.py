"""The training-data queries that SQL can express equal their DuckDB SQL."""

import pytest

from conftest import SF_CHECK
from chunkwise.llm.queries import ORACLE, QUERIES
from chunkwise.plans.verify import duckdb_connection


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    got = QUERIES[name](spark, SF_CHECK).toPandas()
    want = duckdb_connection(SF_CHECK).execute(ORACLE[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = [df[cols].astype(object).where(df[cols].notna(), None).values.tolist() for df in (got, want)]
    assert sorted(rows[0], key=repr) == sorted(rows[1], key=repr)
