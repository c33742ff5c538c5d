"""Names of the corpus queries, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan `Tables -> DataFrame` under `name`."""

    def wrap(plan: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, root: plan(Tables(spark, root))
        if sql:
            SQL[name] = sql
        return plan

    return wrap
