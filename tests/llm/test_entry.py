"""Registration of the queries and their SQL."""

from __future__ import annotations

import pytest
from oracle_harness import compare, duck

import __spark_entry__ as entry
from wagegrid.llm import entry as llm_entry


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in llm_entry.queries())
    assert numbers == list(range(1, 14))
    assert set(llm_entry.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(llm_entry.oracle_sql()))
def test_query_matches_its_sql(llm, sf, name):
    r = compare(llm, name, entry.queries()[name], llm_entry.oracle_sql()[name], sf, duck(sf))
    assert r["status"] == "ok", r
