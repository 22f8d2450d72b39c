"""Predicates that need care to be right or to reach the parquet reader."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import folded


def equals_literal(df: DataFrame, column: str, value: Any) -> DataFrame:
    """``column = value`` with the literal, not the column, cast to match."""
    kind = df.schema[column].dataType
    return df.filter(F.col(column) == F.lit(value).cast(kind))


def optional_equals(df: DataFrame, column: str, value: Any | None) -> DataFrame:
    """Filter only when a value is given; without one, NULL rows stay as well."""
    return df if value is None else equals_literal(df, column, value)


def text_prefix(column: Column, start: str, ignore_case: bool = False) -> Column:
    """Prefix match on the bare column; pushed down when letter case counts."""
    return (folded(column) if ignore_case else column).startswith(start)


def text_suffix(column: Column, end: str, ignore_case: bool = False) -> Column:
    return (folded(column) if ignore_case else column).endswith(end)


def text_contains(column: Column, part: str, ignore_case: bool = False) -> Column:
    return (folded(column) if ignore_case else column).contains(part)


def outside_range(
    column: Column, low: Any, high: Any, keep_null: bool = False
) -> Column:
    """``column < low OR column >= high``; NULLs only pass with ``keep_null``."""
    outside = (column < F.lit(low)) | (column >= F.lit(high))
    return outside | column.isNull() if keep_null else outside


def has_rows(df: DataFrame) -> bool:
    """Whether ``df`` has any row.

    Spark looks at one partition, then at more, and stops at the first row,
    where a count would read them all.
    """
    return not df.isEmpty()
