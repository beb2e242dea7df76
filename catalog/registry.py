"""Registered queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows if there is any."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def r6(column: Column | str) -> Column:
    """Six decimals, and no negative zero: float sums depend on the order of rows."""
    return F.round(column, 6) + F.lit(0.0)


def sql6(expression: str) -> str:
    return f"(round({expression}, 6) + 0.0)"
