"""The list of named queries."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelgrove.plans.sql_views import VIEWS
from reelgrove.session import ship_package, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _needed(sql: str) -> list[str]:
    """Views a text names, directly or through other views, each after what it needs."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in ordered and re.search(rf"\b{name}\b(?!\s*\()", text):
                if VIEWS[name] is not text:
                    visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    return ordered


def with_views(sql: str) -> str:
    body = sql.strip()
    views = [f"{name} AS ({VIEWS[name].strip()})" for name in _needed(body)]
    if not views:
        return body
    head = "WITH " + ",\n".join(views)
    if body.upper().startswith("WITH "):
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return fn(tune(spark), folder)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return add
