"""Queries of the training-data operators, one opN_<name> per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.llm import queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(queries.ALL)
SQL: dict[str, str] = dict(queries.SQL)
