"""Registry of runnable queries, each with the equivalent SQL where one exists."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.plans.standins import STANDIN_SQL, Standins

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def with_standins(body: str) -> str:
    """Put the stand-in relations a statement names in front of it as CTEs."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in STANDIN_SQL:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(STANDIN_SQL[name])

    visit(body)
    ctes = [f"{n} as ({STANDIN_SQL[n]})" for n in STANDIN_SQL if n in needed]
    body = body.strip()
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join(ctes) + ",\n" + body[len("with recursive "):]
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[len("with "):]
    return "with " + ",\n".join(ctes) + "\n" + body


def query(name: str, sql: str | None = None):
    """Register ``fn(standins) -> DataFrame`` under a name."""

    def wrap(fn: Callable[[Standins], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Standins(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_standins(sql)
        return fn

    return wrap
