"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01; run ``python tests/oracle_harness.py``)."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from oracle_harness import compare, duck
from wagegrid.plans import oracle, queries

QUERIES = queries.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE.get(name), SF_SMALL, con)
    assert r["status"] == "ok", r
