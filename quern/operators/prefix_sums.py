"""Running sums over a whole table without a window over the whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.ranking import _LOCAL_BITS, number_copies
from quern.session import materialize


def prefix_sums(
    df: DataFrame,
    order_by: Sequence[str | Column],
    sums: Mapping[str, Column],
    unique: bool = True,
    totals: bool = False,
) -> DataFrame:
    """Add, per name in ``sums``, the sum of its expression over all rows up to this one.

    Rows are range-partitioned and sorted once and written to the shared folder with
    their place.  Each range is summed up alone, and the sums of the ranges before it,
    one row per range, become offsets.  ``order_by`` must be a total key, which also
    spreads the rows when its leading column has a frequent value; for a table without
    one pass ``unique=False``.  NULLs add nothing.  ``totals`` adds ``total_<name>``, the
    sum over all rows.
    """
    columns = df.columns
    if not unique:
        df = number_copies(df, "__copy")
        order_by = [*order_by, *columns, "__copy"]
    placed = materialize(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("__place", F.monotonically_increasing_id()),
        "prefix-sums",
    ).withColumn("__part", F.shiftright("__place", _LOCAL_BITS))
    per_part = placed.groupBy("__part").agg(*[F.sum(a).alias(n) for n, a in sums.items()])
    # One row per range: windows over them and a broadcast are small.
    everything = Window.orderBy("__part")
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_part.select(
        "__part",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__before_{n}") for n in sums],
        *[F.coalesce(F.sum(n).over(whole), F.lit(0)).alias(f"total_{n}") for n in sums],
    )
    within = Window.partitionBy("__part").orderBy("__place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = placed.select(
        "__part", *columns, *[F.sum(a).over(within).alias(f"__within_{n}") for n, a in sums.items()]
    )
    return running.join(F.broadcast(offsets), "__part").select(
        *columns,
        *[
            (F.col(f"__before_{n}") + F.coalesce(f"__within_{n}", F.lit(0))).alias(n)
            for n in sums
        ],
        *[f"total_{n}" for n in sums if totals],
    )


def running_total(
    df: DataFrame, order_by: Sequence[str | Column], amount: Column, column: str,
    poisoned: str | None = None, unique: bool = True,
) -> DataFrame:
    """Add the running total of an amount, and the same as a loop over the rows has it.

    ``column`` skips NULL amounts, as SUM does.  ``poisoned`` names the total of a loop
    that adds each amount to a variable: a NULL makes it NULL for all later rows.
    """
    sums = {column: amount.cast("decimal(28,0)")}
    if poisoned is not None:
        sums["__unknown"] = amount.isNull().cast("bigint")
    found = prefix_sums(df, order_by, sums, unique)
    if poisoned is None:
        return found
    return found.withColumn(
        poisoned, F.when(F.col("__unknown") == 0, F.col(column))
    ).drop("__unknown")


def first_above(
    running: DataFrame, order_by: Sequence[str | Column], column: str, limit: Column
) -> DataFrame:
    """The row at which a loop would stop: the first whose total exceeds ``limit``."""
    return running.filter(F.col(column) > limit).orderBy(*order_by).limit(1)
