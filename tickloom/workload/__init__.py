"""Registered queries over the test tables and the SQL they are checked with."""

from tickloom.workload import dimensions, indicators, jobs, quality, relational, tables  # noqa: F401
from tickloom.workload.registry import QUERIES

__all__ = ["QUERIES"]
