"""Queries of the package by name, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class LlmQuery:
    run: Run
    sql: str | None = None


QUERIES: dict[str, LlmQuery] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = LlmQuery(run, sql)
        return run

    return add
