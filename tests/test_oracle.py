"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from casewatch.queries import REGISTRY
from tests.oracle_compare import compare, duck

KEYS = list(REGISTRY)  # the optional operators' queries are compared in their own tests


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql()) and set(KEYS) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "disease_rank_in_state" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, sf_small, con, key):
    r = compare(spark, key, sf_small, entry.queries()[key], entry.oracle_sql()[key], con)
    assert r["status"] == "ok", r
