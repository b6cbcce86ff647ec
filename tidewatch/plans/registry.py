"""Collects the registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from .tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register ``build(tables) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB statement for the same result; ``views`` names the derived views it
    reads (space separated), which are put in front as common table expressions.
    """
    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(tune(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(views, sql)
        return build
    return register


def with_views(views: str, sql: str) -> str:
    from .tables import VIEW_SQL, VIEW_NEEDS

    wanted: list[str] = []

    def add(view: str) -> None:
        for need in VIEW_NEEDS.get(view, ()):
            add(need)
        if view not in wanted:
            wanted.append(view)

    for view in views.split():
        add(view)
    body = sql.strip().rstrip(";")
    if not wanted:
        return body
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v].strip()})" for v in wanted)
    keyword = "WITH RECURSIVE" if body.upper().startswith("WITH RECURSIVE") else "WITH"
    if body.upper().startswith("WITH"):
        rest = body[len(keyword):].lstrip()
        return f"{keyword} {ctes},\n{rest}"
    return f"WITH {ctes}\n{body}"
