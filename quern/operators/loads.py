"""Loads that respect rules: CHECK, UNIQUE, NOT NULL, FOREIGN KEY."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _broken(rules: Mapping[str, Column]) -> Column:
    # As with a CHECK, a rule that is unknown because of a NULL lets the row pass.
    failed = [~F.coalesce(rule, F.lit(True)) for rule in rules.values()]
    return reduce(lambda a, b: a | b, failed, F.lit(False))


@dataclass(frozen=True)
class Load:
    """Result of a checked load; ``violations`` and ``loaded`` are per batch."""

    table: DataFrame
    violators: DataFrame
    violations: list[int]
    loaded: list[bool]
    message: str | None

    def log(self) -> DataFrame:
        """One row per batch: number of violators and whether it was loaded."""
        rows = [
            (i, n, done)
            for i, (n, done) in enumerate(zip(self.violations, self.loaded), 1)
        ]
        return self.table.sparkSession.createDataFrame(
            rows, "batch int, violations bigint, loaded boolean"
        )


def checked_load(
    target: DataFrame,
    batches: Sequence[DataFrame],
    rules: Mapping[str, Column],
    mode: str = "statement",
) -> Load:
    """Append batches to a table under row rules.

    A batch with a violating row is refused as a whole.  With mode ``statement``
    the other batches are still loaded; with ``all`` nothing is.  Each batch
    costs one aggregate for its number of violations; its rows stay on the
    executors.
    """
    if mode not in ("statement", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    broken = _broken(rules)
    violations = [batch.agg(F.count_if(broken)).first()[0] for batch in batches]
    clean = not any(violations)
    loaded = [n == 0 and (clean or mode == "statement") for n in violations]
    refused = len(batches) - sum(loaded)
    message = None if clean else f"{refused} of {len(batches)} batches were refused"
    violators = [
        batch.filter(broken).withColumn("batch", F.lit(i))
        for i, batch in enumerate(batches, 1)
    ]
    return Load(
        reduce(DataFrame.unionByName, [b for b, ok in zip(batches, loaded) if ok], target),
        reduce(DataFrame.unionByName, violators),
        violations,
        loaded,
        message,
    )


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values on more than one row, with their number of rows."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs per column, in one row.

    Read from the data: a NOT NULL declaration of a parquet table proves nothing.
    """
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def orphans(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose key is set but has no parent row."""
    return child.filter(F.col(key).isNotNull()).join(
        parent.select(F.col(parent_key).alias("__parent")),
        F.col(key) == F.col("__parent"),
        "left_anti",
    )


def key_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Number of offending rows per named check."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts)
