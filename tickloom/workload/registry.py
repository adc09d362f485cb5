"""Queries by name, each with the DuckDB SQL it is checked against, where there is one."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tickloom.workload.fixture_sql import FIXTURES

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, **ctes: str) -> Callable[[Run], Run]:
    """Register a query. ``ctes`` are named subqueries of ``sql``, in order."""

    def add(run: Run) -> Run:
        QUERIES[name] = Query(run, None if sql is None else with_fixtures(sql, ctes))
        return run

    return add


def with_fixtures(sql: str, ctes: dict[str, str] | None = None) -> str:
    """``sql`` with the fixtures it mentions, directly or not, as CTEs before it."""
    own = dict(ctes or {})
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in FIXTURES.items():
            mentioned = re.search(rf"\b(?:from|join)\s+{name}\b", text, re.IGNORECASE)
            if name not in own and name not in needed and mentioned:
                visit(body)
                needed.append(name)

    for body in own.values():
        visit(body)
    visit(sql)
    parts = [f"{n} AS MATERIALIZED ({FIXTURES[n]})" for n in needed]
    parts += [f"{n} AS ({body})" for n, body in own.items()]
    return f"WITH RECURSIVE {', '.join(parts)} {sql}" if parts else sql
