"""Registration of queries and composition of their SQL from shared common table expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketloom.queries.oracle import TABLES

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; names start with the identifiers of the operators they cover."""

    def add(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = with_tables(sql)
        return fn

    return add


def with_tables(sql: str) -> str:
    """Prefix the shared tables that the statement mentions, directly or through each other."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(body)

    visit(sql)
    parts = [f"{name} AS ({body.strip()})" for name, body in TABLES.items() if name in needed]
    return f"WITH RECURSIVE {', '.join(parts)} {sql.strip()}" if parts else sql.strip()


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
