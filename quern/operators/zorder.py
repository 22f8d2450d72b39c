"""Clustering of a table by several columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per column: 2 ** BITS ranges of about equal numbers of rows.
BITS = 8


def place_in(cuts: Column, value: Column, bits: int) -> Column:
    """How many of 2 ** bits - 1 ascending cuts are at most ``value``, by bisection."""
    steps = F.array(*[F.lit(1 << b) for b in range(bits - 1, -1, -1)])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at + F.when(F.get(cuts, at + step - 1) <= value, step).otherwise(0),
    )


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of several ranks, the highest of each first."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            taken = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            out = F.shiftleft(out, 1).bitwiseOR(taken)
    return out


def with_z_value(
    df: DataFrame, columns: Sequence[str], name: str, bits: int = BITS, accuracy: int = 10_000
) -> DataFrame:
    """Add a number whose order keeps rows near that are near in every column.

    A value becomes the number of its range among 2 ** bits of about equal size, from
    approximate quantiles: one scan, one small state per task, and arrays of 2 ** bits
    numbers per row of the plan.  NULL has the lowest rank.  Columns are numbers or times.
    """
    if bits * len(columns) > 63:
        raise ValueError("too many columns for one 64-bit number")
    marks = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [_as_number(df, c) for c in columns]
    cuts = F.struct(
        *[F.percentile_approx(n, marks, accuracy).alias(f"c{i}") for i, n in enumerate(numbers)]
    )
    ranks = {
        f"__rank{i}": F.coalesce(place_in(F.col(f"__cuts.c{i}"), n, bits), F.lit(0))
        for i, n in enumerate(numbers)
    }
    return (
        df.withColumn("__cuts", df.agg(cuts).scalar())
        .withColumns(ranks)
        .withColumn(name, interleaved([F.col(r) for r in ranks], bits))
        .drop("__cuts", *ranks)
    )


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        value = value.cast("timestamp")
    return value.cast("double")


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    spread_by: Sequence[str] = (),
    bits: int = BITS,
    compression: str = "zstd",
    block_bytes: int | None = None,
) -> DataFrame:
    """Write a table so that statistics skip row groups for filters on any column.

    Rows are range-partitioned and sorted by their interleaved ranks, then by the columns
    and ``spread_by``, which also spread a frequent combination over the tasks.
    """
    key = [F.col("__z"), *columns, *spread_by]
    writer = (
        with_z_value(df, columns, "__z", bits)
        .repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .select(*df.columns)
        .write.option("compression", compression)
    )
    if block_bytes is not None:
        writer = writer.option("parquet.block.size", block_bytes)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
