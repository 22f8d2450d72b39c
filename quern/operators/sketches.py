"""Column statistics in small mergeable states, kept per batch of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, NumericType, StringType

#: log2 of the registers of a distinct-count state, and its relative standard error.
REGISTERS = 12
DISTINCT_ERROR = 1.04 / (1 << REGISTERS) ** 0.5
#: Rank error of a quantile state with its default size, at 99 % confidence.
RANK_ERROR = 0.0165


def _distinct_input(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    known = isinstance(kind, (IntegerType, LongType, StringType))
    return F.col(name) if known else F.col(name).cast("string")


def sketch_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, NULLs, and the states for distinct values and, of a
    numeric column, quantiles.  One scan, and one small row per task is shuffled."""
    aggregates = []
    for i, name in enumerate(columns):
        numeric = isinstance(df.schema[name].dataType, NumericType)
        marks = F.kll_sketch_agg_double(F.col(name).cast("double")) if numeric else None
        aggregates += [
            F.count(name).alias(f"known{i}"),
            F.hll_sketch_agg(_distinct_input(df, name), F.lit(REGISTERS)).alias(f"distinct{i}"),
            (F.lit(None).cast("binary") if marks is None else marks).alias(f"marks{i}"),
        ]
    whole = df.agg(F.count(F.lit(1)).alias("n"), *aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("n").alias("n_rows"),
                (F.col("n") - F.col(f"known{i}")).alias("n_nulls"),
                F.col(f"distinct{i}").alias("distinct_state"),
                # An empty quantile state is not kept.
                F.when(F.col(f"known{i}") > 0, F.col(f"marks{i}")).alias("quantile_state"),
            )
            for i, name in enumerate(columns)
        ]
    )
    return whole.select(F.inline(rows))


def merge_sketches(states: DataFrame) -> DataFrame:
    """States of all batches united, one row per column."""
    return states.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.hll_union_agg("distinct_state").alias("distinct_state"),
        F.kll_merge_agg_double("quantile_state").alias("quantile_state"),
        F.count("quantile_state").alias("n_quantile_states"),
    )


def sketch_report(merged: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Estimated distinct values and quantiles of merged states."""
    marks = [
        F.when(
            F.col("n_quantile_states") > 0,
            F.kll_sketch_get_quantile_double("quantile_state", F.lit(float(r))),
        )
        for r in ranks
    ]
    return merged.select(
        "column_name",
        "n_rows",
        "n_nulls",
        F.hll_sketch_estimate("distinct_state").alias("distinct_estimate"),
        F.array(*marks).alias("quantiles"),
    )


class SketchStore:
    """States per batch in a folder; a batch that is added again replaces its own.

    Adding reads the new rows only, and a report reads states only: a few kilobytes per
    column and batch.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.columns = list(columns)

    def add(self, rows: DataFrame, batch: int) -> None:
        states = sketch_columns(rows, self.columns)
        states.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch}")

    def merged(self) -> DataFrame:
        return merge_sketches(self.spark.read.parquet(self.path))

    def report(self, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
        return sketch_report(self.merged(), ranks)
