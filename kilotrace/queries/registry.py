"""Where queries register themselves, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kilotrace.sources.domain import VIEWS, named

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def with_views(sql: str) -> str:
    """``sql`` after the definitions of the domain views it reads."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in named(text):
            if name in VIEWS and name not in needed:
                add(VIEWS[name])
                needed.append(name)

    add(sql)
    head = ", ".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    body = sql.strip()
    if not needed:
        return body
    return f"WITH {head}, {body[5:]}" if body.startswith("WITH ") else f"WITH {head} {body}"


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` is for DuckDB and may name the domain views."""

    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = with_views(sql)
        return f

    return register
