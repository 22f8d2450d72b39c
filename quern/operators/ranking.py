"""Row numbers, positions and top-n without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import materialize

#: One ordering term: a column name and whether it descends.
Term = tuple[str, bool]

_BUCKETS = 1 << 16
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in these bits


def sort_columns(terms: Sequence[Term]) -> list[Column]:
    """Ordering columns with NULL as the lowest value in both directions."""
    return [
        F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first()
        for c, down in terms
    ]


def number_copies(df: DataFrame, column: str, chunk: int = 1_000_000) -> DataFrame:
    """Number equal rows 1, 2, … so that all rows become distinct.

    Copies are counted, which combines them map-side, and written out again from
    the count.  The copies of a very frequent row are written by several tasks.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    rare = counted.filter(F.col("__copies") <= chunk).withColumn(
        "__first", F.lit(1).cast("bigint")
    )
    firsts = F.sequence(F.lit(1).cast("bigint"), F.col("__copies"), F.lit(chunk))
    frequent = (
        counted.filter(F.col("__copies") > chunk)
        .withColumn("__first", F.explode(firsts))
        .repartition(*df.columns, "__first")
    )
    last = F.least(F.col("__first") + F.lit(chunk - 1), F.col("__copies"))
    return rare.unionByName(frequent).select(
        *df.columns, F.explode(F.sequence("__first", last)).alias(column)
    )


def global_positions(
    df: DataFrame,
    order_by: Sequence[str | Column],
    column: str,
    start: int = 1,
    unique: bool = True,
) -> DataFrame:
    """Add the position of each row in a total order.

    Rows are range-partitioned and sorted once and written to the shared folder
    with their place inside the partition.  The sizes of the partitions, one row
    each, become offsets.  ``order_by`` must be a total key: it also spreads the
    rows when one value of the leading column is frequent.  For a table without
    such a key pass ``unique=False``: the other columns and a number per copy
    then complete the order.
    """
    columns = df.columns
    if not unique:
        df = number_copies(df, "__copy")
        order_by = [*order_by, *columns, "__copy"]
    placed = materialize(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("__place", F.monotonically_increasing_id()),
        "positions",
    )
    part = F.shiftright("__place", _LOCAL_BITS)
    within = F.col("__place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    sizes = placed.groupBy(part.alias("__part")).agg(
        (F.max(within) + 1).alias("__rows")
    )
    # One row per shuffle partition: a window and a broadcast of that are small.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .select(
            (F.col("__offset") + within + F.lit(start)).alias(column), *columns
        )
    )


def top_numbered(
    df: DataFrame, terms: Sequence[Term], count: int, column: str = "row_number"
) -> DataFrame:
    """First ``count`` rows of a total order, numbered in that order.

    The rows are cut first, so the window only sees ``count`` of them.
    """
    order = sort_columns(terms)
    best = df.orderBy(*order).limit(count)
    number = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return best.withColumn(column, number)


def _precedes(left: Column, right: Column, terms: Sequence[Term]) -> Column:
    """Whether ``left`` sorts before ``right``; both hold the ordering columns."""
    verdict = F.lit(False)
    for name, down in reversed(terms):
        a, b = (right[name], left[name]) if down else (left[name], right[name])
        lower = F.coalesce(a < b, a.isNull() & b.isNotNull())
        verdict = lower | (a.eqNullSafe(b) & verdict)
    return verdict


def top_with_position(
    df: DataFrame,
    pick: Sequence[Term],
    count: int,
    position: Sequence[Term],
    column: str = "row_number",
) -> DataFrame:
    """First ``count`` rows by ``pick``, with their place in order ``position``.

    Both orders must be total.  The table is not sorted a second time: each row
    is counted in the slot of how many picked rows it precedes, which is a small
    map-side aggregate, found by bisection in the sorted picked rows.  A picked row
    comes after exactly the rows whose slot is higher than its own.
    """
    names = [name for name, _ in position]
    best = df.orderBy(*sort_columns(pick)).limit(count)
    in_order = F.array_sort(
        F.collect_list(F.struct(*df.columns)),
        lambda a, b: F.when(_precedes(a, b, position), -1).when(_precedes(b, a, position), 1).otherwise(0),
    )
    picked = best.agg(in_order.alias("__rows"))
    marks = picked.select(F.transform("__rows", lambda r: F.struct(*[r[n].alias(n) for n in names]))).scalar()
    here = F.struct(*names)

    def not_after(at: Column) -> Column:
        """Whether the mark at this place exists and the row does not precede it."""
        mark = F.get("__marks", at)
        return mark.isNotNull() & ~_precedes(here, mark, position)

    steps = F.array(*[F.lit(1 << b) for b in range(count.bit_length() - 1, -1, -1)])
    passed = F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(not_after(at + step - 1), step).otherwise(0)
    )
    slot = F.size("__marks") - passed
    slots = (
        df.select(*names, marks.alias("__marks"))
        .groupBy(slot.alias("__slot"))
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    # At most count + 1 slots exist, so this window stays small.
    higher = Window.orderBy(F.col("__slot").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ahead = slots.select(
        "__slot", F.coalesce(F.sum("__rows").over(higher), F.lit(0)).alias("__ahead")
    )
    placed = picked.select(F.size("__rows").alias("__n"), F.posexplode("__rows").alias("__at", "__row"))
    return (
        placed.select((F.col("__n") - F.col("__at") - 1).alias("__slot"), "__row.*")
        .join(ahead, "__slot")
        .select(*df.columns, (F.col("__ahead") + 1).alias(column))
    )


def _bucket(group: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*group), F.lit(_BUCKETS))


def frequent_buckets(df: DataFrame, group: Sequence[str], rows: int) -> list[int]:
    """Hash buckets of groups with more than ``rows`` rows.

    Rows are counted per bucket, which combines map-side to a fixed number of
    counters.  No such group is missed; a bucket may also hold small groups, or
    only such, which changes the plan for them but not their result.
    """
    counted = df.groupBy(_bucket(group).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return [r["bucket"] for r in counted.filter(F.col("n_rows") > rows).collect()]


def number_within(
    df: DataFrame,
    group: Sequence[str],
    terms: Sequence[Term],
    column: str = "row_number",
    hot_rows: int = 20_000_000,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each group in a total order.

    Groups of ordinary size use a window.  A group with more than ``hot_rows``
    rows would keep one task busy alone, so such groups are range-partitioned by
    their order and numbered through :func:`global_positions`.  ``sized_by`` may
    name a cheaper source of the same groups, at least as large, to find them.
    """
    order = sort_columns(terms)
    window = Window.partitionBy(*group).orderBy(*order)
    number = F.row_number().over(window).cast("bigint")
    hot = frequent_buckets(df if sized_by is None else sized_by, group, hot_rows)
    if not hot:
        return df.withColumn(column, number)

    is_hot = _bucket(group).isin(hot)
    numbered = df.filter(~is_hot).withColumn(column, number)

    in_group_order = [*sort_columns([(g, False) for g in group]), *order]
    placed = global_positions(
        df.filter(is_hot), in_group_order, "__position", unique=False
    )
    starts = placed.groupBy(*[F.col(g).alias(f"__{g}") for g in group]).agg(
        F.min("__position").alias("__first")
    )
    same = reduce(
        lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]
    )
    place = (F.col("__position") - F.col("__first") + 1).alias(column)
    return numbered.unionByName(placed.join(starts, same).select(*df.columns, place))
