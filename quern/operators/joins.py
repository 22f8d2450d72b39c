"""Joins beyond a plain ``df.join``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Join methods that keep an equality join distributed.  A replicated nested
#: loop is left out: it compares every pair of rows.
METHODS = ("broadcast", "merge", "shuffle_hash")


def apply_keyed(
    rows: DataFrame,
    keyed: DataFrame,
    on: Column | str | Sequence[str],
    keep_unmatched: bool = False,
) -> DataFrame:
    """Look up each row's key in ``keyed``, a function of the key as a table."""
    return rows.join(keyed, on, "left" if keep_unmatched else "inner")


def where_key_exists(
    rows: DataFrame, keyed: DataFrame, on: Column | str | Sequence[str]
) -> DataFrame:
    """Rows whose key occurs in ``keyed``; repeated keys there add no rows."""
    return rows.join(keyed, on, "left_semi")


def join_by(
    left: DataFrame,
    right: DataFrame,
    on: Column | str | Sequence[str],
    method: str,
    broadcast_rows: int = 200_000,
    broadcast_bytes: int = 64 * 1024 * 1024,
) -> DataFrame:
    """Inner join with a requested method.

    The right side is only broadcast after a check that it has at most
    ``broadcast_rows`` rows and takes at most ``broadcast_bytes``; beyond that the join
    shuffles.
    """
    if method not in METHODS:
        raise ValueError(f"unknown join method {method!r}, expected one of {METHODS}")
    if method == "broadcast" and not fits(right, broadcast_rows, broadcast_bytes):
        method = "merge"
    return left.join(right.hint(method), on, "inner")


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; reads little more than that."""
    return df.limit(rows + 1).count() <= rows


def fits(df: DataFrame, rows: int, size: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows and about ``size`` bytes.

    Both are measured on ``rows`` + 1 rows at most.  A row's bytes are those of its JSON
    form, which names its columns, so the estimate is on the safe side.
    """
    width = F.octet_length(F.to_json(F.struct("*")))
    found = df.limit(rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return found["n"] <= rows and found["bytes"] <= size


def pair_with_few(rows: DataFrame, few: DataFrame, max_few: int = 1_000) -> DataFrame:
    """Every row of ``rows`` next to every row of a small list.

    The list is checked to be small, becomes an array constant and is exploded
    in place, so ``rows`` is neither shuffled nor joined.  A longer list is
    refused, because the result would grow with the product of both sizes.
    """
    if not at_most(few, max_few):
        raise ValueError(f"the smaller side has more than {max_few} rows")
    items = few.collect()
    fields = few.schema.fields
    constant = F.array(
        *[
            F.struct(
                *[F.lit(item[f.name]).cast(f.dataType).alias(f.name) for f in fields]
            )
            for item in items
        ]
    )
    if not items:
        constant = constant.cast(f"array<{few.schema.simpleString()}>")
    return rows.select("*", F.explode(constant).alias("__item")).select(
        *rows.columns, "__item.*"
    )


def latest_per_key(
    rows: DataFrame,
    key: str,
    order: str,
    keyed: DataFrame | None = None,
    keyed_key: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Rows that hold the highest ``order`` value of their key, ties included.

    If ``order`` is unique within a key, ``unique=True`` reads the rows once: the best row
    of each key is kept map-side, and one row per key and task is shuffled.

    With ``keyed``, whose ``keyed_key`` is unique, only its keys are kept and its
    columns are added; it is joined to the aggregate, not to the rows.  The
    maximum is aggregated map-side first, and the join back is on both columns,
    so the rows of one hot key spread over the partitions.
    """
    if unique:
        best = rows.groupBy(F.col(key).alias("__key")).agg(
            F.max_by(F.struct(*rows.columns), order).alias("__row")
        ).filter(F.col("__key").isNotNull() & F.col("__row").isNotNull())
        found = best.select("__row.*")
        if keyed is None:
            return found
        return found.join(keyed, F.col(key) == F.col(keyed_key)).select(
            *rows.columns, *keyed.columns
        )
    latest = rows.groupBy(F.col(key).alias("__key")).agg(
        F.max(order).alias("__latest")
    )
    added: list[str] = []
    if keyed is not None:
        latest = latest.join(keyed, F.col("__key") == F.col(keyed_key))
        added = keyed.columns
    matches = (F.col(key) == F.col("__key")) & (F.col(order) == F.col("__latest"))
    return rows.join(latest, matches).select(*rows.columns, *added)


def unique_names(df: DataFrame, prefix: str) -> DataFrame:
    """Prefix all columns, so the output of a join can be written as a table."""
    return df.select(*[df[c].alias(f"{prefix}{c}") for c in df.columns])
