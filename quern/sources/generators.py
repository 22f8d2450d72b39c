"""Rows computed from a number sequence, and dense identities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.ranking import global_positions


def numbers(spark: SparkSession, count: int, column: str = "n") -> DataFrame:
    """1, 2, …, ``count`` as BIGINT, made on the executors."""
    return spark.range(1, count + 1).withColumnRenamed("id", column)


def generate(spark: SparkSession, count: int, **columns: Column) -> DataFrame:
    """One row per number; each keyword is an expression over column ``n``."""
    return numbers(spark, count).select(
        *[expr.alias(name) for name, expr in columns.items()]
    )


def skewed_pair(
    spark: SparkSession, count: int, single: int, frequent: int
) -> DataFrame:
    """Id 1 carries ``single``; ids 2 … ``count`` + 1 all carry ``frequent``."""
    value = F.when(F.col("n") == 1, F.lit(single)).otherwise(F.lit(frequent))
    return generate(spark, count + 1, id=F.col("n"), value=value)


def with_dense_id(
    df: DataFrame,
    order_by: Sequence[str | Column],
    column: str = "id",
    start: int = 1,
    unique: bool = True,
) -> DataFrame:
    """Number all rows start, start+1, … in the order of a total key.

    A table column of identity kind does not exist on parquet; see
    :func:`quern.operators.ranking.global_positions` for the plan, and for
    ``unique``, which tells whether ``order_by`` is a key of the table.
    """
    return global_positions(df, order_by, column, start, unique)
