"""Literal rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def literal_rows(spark: SparkSession, schema: str, rows: Iterable[tuple]) -> DataFrame:
    """The given rows under a DDL schema; stands for a VALUES list."""
    return spark.createDataFrame(list(rows), schema)


def append_rows(df: DataFrame, columns: list[str], rows: Iterable[tuple]) -> DataFrame:
    """``df`` plus literal rows; columns that are not listed become NULL."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    ddl = ", ".join(f"`{c}` {types[c]}" for c in columns)
    extra = literal_rows(df.sparkSession, ddl, rows)
    return df.unionByName(extra, allowMissingColumns=True)
