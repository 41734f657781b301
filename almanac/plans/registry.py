"""All registered queries and their oracle SQL."""

from __future__ import annotations

from almanac.plans import (
    health_oracle,
    health_queries,
    lake_oracle,
    lake_queries,
    retail_oracle,
    retail_queries,
    run_oracle,
    run_queries,
)

_QUERIES = [retail_queries.QUERIES, health_queries.QUERIES, lake_queries.QUERIES, run_queries.QUERIES]
_ORACLES = [retail_oracle.ORACLE, health_oracle.ORACLE, lake_oracle.ORACLE, run_oracle.ORACLE]


def queries() -> dict:
    return {name: fn for part in _QUERIES for name, fn in part.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _ORACLES for name, sql in part.items()}
