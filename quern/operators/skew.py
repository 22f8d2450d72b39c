"""Equality joins whose frequent keys are frequent on both sides."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.joins import fits
from quern.operators.ranking import _bucket
from quern.session import materialize

HOW = ("inner", "left")
#: A key with fewer rows is never cut.
LEAST_ROWS = 10_000
#: Rows of one side, over all buckets, that may be copied to each task of the other, and
#: their bytes.
FEW_ROWS = 1_000
FEW_BYTES = 8 * 1024 * 1024


def heavy_buckets(
    left: DataFrame, left_on: Sequence[str], right: DataFrame, right_on: Sequence[str],
    rows: int | None = None,
) -> tuple[list[tuple[int, int, int]], int]:
    """Hash buckets of keys with more than ``rows`` rows on a side, with both counts.

    Rows are counted per bucket, which combines map-side to a fixed number of counters.
    No frequent key is missed; a bucket may also hold small keys, or only such.  Without
    ``rows`` the limit is an even share of both tables per shuffle partition.
    """
    def counted(df: DataFrame, on: Sequence[str], name: str) -> DataFrame:
        return df.groupBy(_bucket(on).alias("bucket")).agg(F.count(F.lit(1)).alias(name))

    both = counted(left, left_on, "n_left").join(
        counted(right, right_on, "n_right"), "bucket", "full"
    )
    found = [(r.bucket, r.n_left or 0, r.n_right or 0) for r in both.collect()]  # 65,536 at most
    if rows is None:
        tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = max(LEAST_ROWS, sum(n + m for _, n, m in found) // tasks)
    return [f for f in found if max(f[1:]) > rows], rows


def _with_few(
    df: DataFrame, on: Sequence[str], counted: list[tuple[int, int]]
) -> tuple[list[int], DataFrame | None]:
    """Those of the buckets, smallest first, whose rows in ``df`` are few in all, and the rows.

    Whatever does not fit is left to be cut, so the rows are bounded by count and size.
    """
    total, found = 0, []
    for n, bucket in sorted((n, bucket) for bucket, n in counted):
        total += n
        if total > FEW_ROWS:
            break
        found.append(bucket)
    if not found:
        return [], None
    rows = df.filter(_bucket(on).isin(found))
    return (found, rows) if fits(rows, FEW_ROWS, FEW_BYTES) else ([], None)


def _same(left_on: Sequence[str], right_on: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in zip(left_on, right_on)]
    )


def _fragments(
    df: DataFrame, on: Sequence[str], own: str, other: str, counts: DataFrame
) -> DataFrame:
    """Rows of heavy buckets, each in one fragment of its side, once per fragment of the
    other side.  Places are stored, so a task that runs again deals alike."""
    placed = materialize(df.withColumn("__place", F.monotonically_increasing_id()), "heavy-rows")
    return (
        placed.withColumn("__bucket", _bucket(on))
        .join(F.broadcast(counts), "__bucket")  # at most one row per heavy bucket
        .withColumn(f"__{own}", F.pmod(F.xxhash64("__place"), F.col(f"__n_{own}")))
        .withColumn(f"__{other}", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"__n_{other}") - 1)))
        .select(*df.columns, f"__{own}", f"__{other}")
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "inner",
    rows: int | None = None,
) -> DataFrame:
    """Join on equal keys without one task that holds a frequent key.

    Keys in ordinary hash buckets are joined as usual.  Where a bucket has more than
    ``rows`` rows on a side (an even share per task, if not given) and few on the other,
    the few are copied to the tasks that read the many, which then stay where they are.
    Other such buckets are cut into fragments of about that size; each left fragment meets
    each right one in a task of its own, so rows are copied as often as the other side has
    fragments, and no others are.  Which way a key goes changes the plan, not the result.
    Column names of both sides have to differ; NULL keys match nothing, and a left join
    keeps their rows.
    """
    if how not in HOW:
        raise ValueError(f"unknown join {how!r}, expected one of {HOW}")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    on = _same(left_on, right_on)
    heavy, rows = heavy_buckets(left, left_on, right, right_on, rows)
    if not heavy:
        return left.join(right, on, how)

    def of(df: DataFrame, keys: Sequence[str], numbers: list[int]) -> DataFrame:
        return df.filter(_bucket(keys).isin(numbers))  # one of 65,536 hash buckets each

    every = [b for b, _, _ in heavy]
    found = left.filter(~_bucket(left_on).isin(every)).join(
        right.filter(~_bucket(right_on).isin(every)), on, how
    )
    with_right, few_right = _with_few(right, right_on, [(b, m) for b, _, m in heavy if m <= rows])
    if with_right:
        many = of(left, left_on, with_right)
        found = found.unionByName(many.join(F.broadcast(few_right), on, how))
    with_left, few_left = _with_few(left, left_on, [(b, n) for b, n, _ in heavy if n <= rows])
    if with_left:
        many = of(right, right_on, with_left)
        found = found.unionByName(
            many.join(F.broadcast(few_left), on).select(*left.columns, *right.columns)
        )
    cut = sorted(set(every) - set(with_right) - set(with_left))
    if cut:
        pieces = [
            (b, max(1, -(-n // rows)), max(1, -(-m // rows))) for b, n, m in heavy if b in cut
        ]
        counts = left.sparkSession.createDataFrame(
            pieces, "__bucket long, __n_left long, __n_right long"
        )
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in left_on])
        cut_left = _fragments(of(left, left_on, cut).filter(known), left_on, "left", "right", counts)
        cut_right = _fragments(of(right, right_on, cut), right_on, "right", "left", counts)
        cut_right = cut_right.withColumnsRenamed({"__left": "__l", "__right": "__r"})
        paired = cut_left.join(
            cut_right, on & (F.col("__left") == F.col("__l")) & (F.col("__right") == F.col("__r"))
        ).select(*left.columns, *right.columns)
        found = found.unionByName(paired)
    rest = cut + with_left
    if how == "inner" or not rest:
        return found
    # Left rows whose key the other side lacks: its heavy keys, once each, are few rows.
    keys = of(right, right_on, rest).select(*right_on).distinct()
    alone = of(left, left_on, rest).join(keys, on, "left_anti").select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    )
    return found.unionByName(alone)
