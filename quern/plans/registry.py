"""Registry of named queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from quern.sources.tables import Tables

Plan = Callable[[SparkSession, Tables], DataFrame]


@lru_cache(maxsize=16)
def open_tables(spark: SparkSession, folder: str) -> Tables:
    """The tables of a folder, opened once per session.

    Opening reads a footer per table.  Files that change later are not seen.
    """
    return Tables(spark, folder)


@dataclass(frozen=True)
class Query:
    name: str
    plan: Plan
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.plan(spark, open_tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under its function name, next to its SQL."""

    def register(plan: Plan) -> Plan:
        key = name or plan.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(key, plan, sql)
        return plan

    return register
