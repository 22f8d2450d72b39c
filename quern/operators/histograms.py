"""Equi-height histograms, exact and distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.numeric import ratio
from quern.operators.prefix_sums import prefix_sums
from quern.session import materialize


def step_histogram(df: DataFrame, column: str, steps: int = 200) -> DataFrame:
    """Steps of about equal numbers of rows, as an optimizer's statistics report them.

    A step covers the values above the step before it up to its ``range_hi_key``:
    ``equal_rows`` have that value, ``range_rows`` lie between, with
    ``distinct_range_rows`` different values and ``avg_range_rows`` rows for each.  The
    rows' places in order are cut into ``steps`` parts; a value belongs to the part that
    its last row is in.  A value with at least a part's worth of rows has a step of its
    own, so there are at most twice as many steps, and one more for NULL, which sorts
    first.

    The column is reduced to value counts, which merges a frequent value map-side; their
    running sum gives each value its part.  No window covers the table or its values.
    """
    counts = (
        df.select(F.col(column).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = materialize(counts, "value-counts")
    value, rows = F.col("v"), F.col("n")
    placed = prefix_sums(counts.filter(value.isNotNull()), ["v"], {"upto": rows}, totals=True)
    part = F.call_function("div", (F.col("upto") - 1) * F.lit(steps), F.col("total_upto"))
    placed = materialize(
        placed.select(
            "v", "n", part.alias("part"), (rows * F.lit(steps) >= F.col("total_upto")).alias("own")
        ),
        "value-parts",
    )
    # Values with a step of their own number at most `steps`, and each opens its part.
    own = placed.filter("own").agg(F.collect_list(F.struct("part", "v"))).scalar()
    after = ~F.col("own") & F.exists(
        F.col("__own"), lambda o: (o["part"] == F.col("part")) & (o["v"] < F.col("v"))
    )
    found = (
        placed.withColumn("__own", own)
        .groupBy("part", after.alias("after"))
        .agg(
            F.max(F.struct("v", "n")).alias("top"),
            F.sum("n").alias("n_rows"),
            F.count(F.lit(1)).alias("n_values"),
        )
        .select(
            F.col("top.v").alias("range_hi_key"),
            F.col("top.n").alias("equal_rows"),
            (F.col("n_rows") - F.col("top.n")).alias("range_rows"),
            (F.col("n_values") - 1).alias("distinct_range_rows"),
        )
    )
    unknown = counts.filter(value.isNull()).select(
        value.alias("range_hi_key"),
        rows.alias("equal_rows"),
        F.lit(0).cast("bigint").alias("range_rows"),
        F.lit(0).cast("bigint").alias("distinct_range_rows"),
    )
    # At most 2 * steps + 1 rows are left for this window.
    number = F.row_number().over(Window.orderBy(F.col("range_hi_key").asc_nulls_first()))
    return found.unionByName(unknown).select(
        number.alias("step"),
        "*",
        ratio(F.col("range_rows"), F.nullif("distinct_range_rows", F.lit(0))).alias(
            "avg_range_rows"
        ),
    )
