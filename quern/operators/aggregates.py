"""Aggregates, densities and column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from quern.functions.numeric import ratio


def rollup_then_lookup(
    facts: DataFrame,
    key: str,
    sums: Mapping[str, Column],
    dimension: DataFrame,
    dimension_key: str,
    label: Sequence[str],
) -> DataFrame:
    """Sum facts per key, join the dimension once per key, sum per label.

    ``sums`` are aggregates that can be added up again.  Aggregating first means
    that a hot key is reduced map-side, and the join sees one row per key.
    """
    per_key = facts.groupBy(key).agg(*[a.alias(n) for n, a in sums.items()])
    return (
        per_key.join(dimension, F.col(key) == F.col(dimension_key))
        .groupBy(*label)
        .agg(*[F.sum(n).alias(n) for n in sums])
    )


def footer_extremes(spark: SparkSession, path: str, column: str) -> DataFrame:
    """MIN, MAX and row count of a parquet table from its file footers.

    Needs the V2 reader with pushed aggregates, which are set in a session of
    their own, so other queries keep their reader.  For numbers and dates only.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return reader.read.parquet(path).agg(
        F.min(column).alias("lowest"),
        F.max(column).alias("highest"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def selectivity(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Distinct values over rows, and one over the distinct values.

    The exact form drops repeats map-side before its shuffle; ``approximate``
    needs no shuffle of values at all.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    counted = df.agg(
        count(F.col(column)).alias("distinct_values"),
        F.count(column).alias("n_rows"),
    )
    return counted.select(
        "distinct_values",
        "n_rows",
        ratio(F.col("distinct_values"), F.col("n_rows")).alias("selectivity"),
        ratio(F.lit(1), F.col("distinct_values")).alias("density"),
    )


def prefix_density(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One over the number of distinct rows of (c1), (c1, c2), …

    All prefixes are found in one aggregation: each row stands for its prefixes, which
    are combined map-side, so a task sends every prefix once, and the keys are shuffled
    once however many columns there are.  NULL counts as a value, as in a DISTINCT
    query; of no rows there is no density.
    """
    size = len(columns)
    names = [f"__c{i}" for i in range(size)]
    groups = (
        df.select(*[F.col(c).alias(n) for c, n in zip(columns, names)])
        .rollup(*names)
        .agg(F.grouping_id().alias("__rolled"))
    )
    counts = groups.agg(
        *[
            F.count_if(F.col("__rolled") == (1 << (size - length)) - 1).alias(f"__n{length}")
            for length in range(1, size + 1)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(", ".join(columns[:length])).alias("key_columns"),
                F.col(f"__n{length}").alias("distinct_values"),
            )
            for length in range(1, size + 1)
        ]
    )
    return counts.select(F.inline(rows)).select(
        "key_columns",
        "distinct_values",
        ratio(F.lit(1), F.nullif("distinct_values", F.lit(0))).alias("density"),
    )


def predicate_share(df: DataFrame, first: Column, second: Column) -> DataFrame:
    """Share of rows that pass two predicates, each and both, in one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(first).alias("first_rows"),
        F.count_if(second).alias("second_rows"),
        F.count_if(first & second).alias("both_rows"),
    )
    shares = [
        ratio(F.col(f"{p}_rows"), F.col("n_rows")).alias(f"{p}_share")
        for p in ("first", "second", "both")
    ]
    return counts.select("*", *shares)


def column_profile(
    df: DataFrame,
    columns: Sequence[str],
    where: Column | None = None,
    steps: Sequence[float] = (0.25, 0.5, 0.75),
    accuracy: int = 10_000,
) -> DataFrame:
    """Rows, NULLs, distinct values, density, bounds and quantiles per column.

    Each column is scanned alone and reduced to its value counts first, so a
    frequent value is merged map-side and no row is multiplied for the distinct
    counts of other columns.
    """
    if where is not None:
        df = df.filter(where)
    parts = []
    for name in columns:
        numeric = isinstance(df.schema[name].dataType, NumericType)
        counts = (
            df.select(F.col(name).alias("v"))
            .groupBy("v")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        facts = counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias(
                "n_nulls"
            ),
            F.count("v").alias("n_distinct"),
            F.min("v").cast("string").alias("lowest"),
            F.max("v").cast("string").alias("highest"),
        )
        if numeric:
            marks = df.agg(
                F.percentile_approx(name, list(steps), accuracy).cast("array<double>")
            ).scalar()
        else:
            marks = F.lit(None).cast("array<double>")
        parts.append(
            facts.select(
                F.lit(name).alias("column_name"),
                "n_rows",
                "n_nulls",
                ratio(F.col("n_nulls"), F.nullif(F.col("n_rows"), F.lit(0))).alias(
                    "null_share"
                ),
                "n_distinct",
                ratio(F.lit(1), F.nullif(F.col("n_distinct"), F.lit(0))).alias(
                    "density"
                ),
                "lowest",
                "highest",
                marks.alias("quantiles"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def value_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Exact histogram of a numeric column in bins of equal width.

    One row per bin that has rows: number, rows, distinct values, and lowest and
    highest value.  Values are counted first, so a frequent one is merged
    map-side.
    """
    value = F.col("v")
    counts = (
        df.select(F.col(column).alias("v"))
        .filter(value.isNotNull())
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    bounds = counts.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high")))
    low, high = F.col("bounds.low").cast("double"), F.col("bounds.high").cast("double")
    # The highest value belongs to the last bin; a single value fills the first.
    bucket = F.width_bucket(value.cast("double"), low, high, F.lit(bins))
    place = F.least(F.coalesce(bucket, F.lit(1)), F.lit(bins))
    return (
        counts.withColumn("bounds", bounds.scalar())
        .groupBy(place.cast("int").alias("bin"))
        .agg(
            F.sum("n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_distinct"),
            F.min("v").alias("lowest"),
            F.max("v").alias("highest"),
        )
    )
