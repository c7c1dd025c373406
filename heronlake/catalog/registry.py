"""The table of queries: a Spark function and, where one exists, DuckDB text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from heronlake.sources.views import SQL_VIEWS, Tables


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, views: str = ""):
    """Register a function of :class:`Tables` under its own name."""

    def register(run):
        QUERIES[run.__name__] = Query(run, with_views(sql, views.split()) if sql else None)
        return run

    return register


def with_views(sql: str, views: list[str]) -> str:
    """Put the named derived views in front of a statement."""
    if not views:
        return sql
    head = ",\n".join(f"{v} as ({SQL_VIEWS[v]})" for v in views)
    body = sql.strip()
    if body.lower().startswith("with recursive"):
        return f"with recursive {head},\n{body[14:]}"
    if body.lower().startswith("with"):
        return f"with {head},\n{body[4:]}"
    return f"with {head}\n{body}"


def r(expr: str, digits: int = 2) -> str:
    """DuckDB text of :func:`heronlake.functions.exact.rnd`."""
    return f"cast(round(cast({expr} as decimal(30,8)), {digits}) as double)"


def total(expr: str) -> str:
    return f"cast(sum(cast({expr} as decimal(18,6))) as double)"


def mean(expr: str) -> str:
    return f"({total(expr)} / nullif(count({expr}), 0))"
