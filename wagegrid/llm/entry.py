"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from functools import wraps

from . import queries_conversations, queries_pages, queries_text, queries_vectors, sql
from .shared import ship_package

QUERY_MODULES = (queries_text, queries_pages, queries_vectors, queries_conversations)


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict:
    """Every ``opN_<name>`` function of the query modules, in order of N."""
    found = {name: _shipped(getattr(m, name)) for m in QUERY_MODULES for name in vars(m)
             if name.startswith("op") and name[2:3].isdigit()}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express."""
    return dict(sql.ORACLES)
