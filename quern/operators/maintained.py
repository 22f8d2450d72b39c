"""Aggregates that are stored and kept up to date by deltas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "n_rows"


def _contributions(
    rows: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], sign: int
) -> DataFrame:
    """What each row adds to its group, with ``sign`` -1 for removed rows."""
    amounts = {**sums, ROWS: F.lit(1).cast("bigint")}
    if sign < 0:
        amounts = {name: -amount for name, amount in amounts.items()}
    return rows.select(*keys, *[a.alias(n) for n, a in amounts.items()])


def merge_parts(
    parts: DataFrame, keys: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Add up partial rows per group; a group without rows disappears."""
    return (
        parts.groupBy(*keys)
        .agg(*[F.sum(n).alias(n) for n in [*names, ROWS]])
        .filter(F.col(ROWS) != 0)
    )


def build_view(
    rows: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """Group sums plus the number of rows behind each group."""
    return merge_parts(_contributions(rows, keys, sums, 1), keys, list(sums))


def apply_delta(
    view: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    inserted: DataFrame | None = None,
    deleted: DataFrame | None = None,
) -> DataFrame:
    """New state of the view after rows were inserted and deleted.

    Stored groups and signed delta rows meet in one aggregation, which combines
    them map-side and shuffles once.  The row count tells when a group is gone,
    which the sums alone could not.  The summed expressions must not be NULL: a
    stored sum cannot tell an unknown amount from zero.
    """
    parts = view.select(*keys, *sums, ROWS)
    if inserted is not None:
        parts = parts.unionByName(_contributions(inserted, keys, sums, 1))
    if deleted is not None:
        parts = parts.unionByName(_contributions(deleted, keys, sums, -1))
    return merge_parts(parts, keys, list(sums))
