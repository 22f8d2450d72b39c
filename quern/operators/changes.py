"""Table changes as new table versions.

Parquet tables are not changed in place.  Every function takes a snapshot and
returns the changed rows as a DataFrame, which is then written as a new version.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.numeric import MONEY, money
from quern.functions.text import fixed_width


def update_where(
    df: DataFrame, values: Mapping[str, Column | Any], where: Column | None = None
) -> DataFrame:
    """Set columns on the rows where the predicate is true.

    All new values see the row as it was before.  They are cast back to the
    type of the column they replace.
    """
    columns = []
    for field in df.schema.fields:
        old = F.col(field.name)
        if field.name not in values:
            columns.append(old)
            continue
        new = values[field.name]
        new = (new if isinstance(new, Column) else F.lit(new)).cast(field.dataType)
        if where is not None:
            new = F.when(where, new).otherwise(old)
        columns.append(new.alias(field.name))
    return df.select(*columns)


def delete_where(df: DataFrame, where: Column) -> DataFrame:
    """Drop the rows where the predicate is true; unknown keeps the row."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def soft_delete(df: DataFrame, where: Column, flag: str = "is_deleted") -> DataFrame:
    """Mark rows as deleted and keep them."""
    if flag not in df.columns:
        df = df.withColumn(flag, F.lit(False))
    return update_where(df, {flag: True}, where)


def guarded_update(
    df: DataFrame, column: str, value: Column, key: Column, guard: Column
) -> DataFrame:
    """Update the keyed row only if its current value passes the guard.

    Reading and changing use the same snapshot, so no other change can slip in
    between.
    """
    return update_where(df, {column: value}, key & guard)


def split_fund(
    df: DataFrame, column: str, fund: str, members: Column
) -> tuple[DataFrame, DataFrame]:
    """Share an amount evenly among the members.

    Returns the changed table and one row with the member count, the share and
    what is left of the fund after rounding the share.
    """
    total = F.lit(fund).cast(MONEY)
    size = df.agg(F.count_if(members).alias("members"))
    share = money(total / F.nullif(F.col("members"), F.lit(0)))
    bonus = size.select(share).scalar()
    changed = update_where(df, {column: F.col(column) + bonus}, members)
    balance = size.withColumn("bonus", share).withColumn(
        "balance", money(total - F.col("members") * F.col("bonus"))
    )
    return changed, balance


def retype(df: DataFrame, column: str, kind: str, width: int | None = None) -> DataFrame:
    """Change a column's type and keep its values; ``width`` pads text."""
    value = F.col(column).cast(kind)
    if width is not None:
        value = fixed_width(value, width)
    return df.withColumn(column, value)
