"""Registry of checked queries: a Spark plan and, where SQL can say it, the same question in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mailsieve.fixtures import Views, oracle_sql_text


@dataclass(frozen=True)
class CheckedQuery:
    name: str
    run: Callable[[Views], DataFrame]
    sql: str | None


QUERIES: dict[str, CheckedQuery] = {}


def query(name: str, views: str = "", sql: str | None = None):
    """Register ``fn(views) -> DataFrame`` under ``name``; ``views`` lists the CTEs ``sql`` needs."""

    def add(fn: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = CheckedQuery(name, fn, oracle_sql_text(views.split(), sql) if sql else None)
        return fn

    return add


def bind(q: CheckedQuery) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: q.run(Views(spark, sf_dir))
