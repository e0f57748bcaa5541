"""The queries that SQL can state, against DuckDB on the smallest tables."""

import pytest

from casewatch.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import compare, duck


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, sf_small, key):
    r = compare(spark, key, sf_small, QUERIES[key], ORACLE[key], duck(sf_small))
    assert r["status"] == "ok", r
