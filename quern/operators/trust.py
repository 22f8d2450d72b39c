"""Verified references between tables, which make a join for existence unnecessary."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.versions import read_file, replace_file


class BrokenReference(ValueError):
    """A reference does not hold."""


def table_version(df: DataFrame) -> str:
    """A digest of the files that a table is read from: names, sizes, times.

    Reads the file listing only.  A table without files has no version.
    """
    spark = df.sparkSession
    files = sorted(df.inputFiles())
    if not files:
        return ""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folders = sorted({f.rsplit("/", 1)[0] for f in files})
    names, found = {f.rsplit("/", 1)[1] for f in files}, []
    for folder in folders:
        fs = path(folder).getFileSystem(conf)
        for status in fs.listStatus(path(folder)):
            if status.getPath().getName() in names:
                name = status.getPath().toUri().toString()
                found.append((name, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()


@dataclass(frozen=True)
class Reference:
    """A verified statement: every row of ``child`` has exactly one row of ``parent``."""

    child_key: tuple[str, ...]
    parent_key: tuple[str, ...]
    child_version: str
    parent_version: str


def verify_reference(
    child: DataFrame, child_key: Sequence[str], parent: DataFrame, parent_key: Sequence[str]
) -> Reference:
    """Check a reference and note which versions of both tables it holds for.

    The parent's key has to be unique and not NULL, the child's not NULL and without
    orphans.  Keys are combined map-side before they meet, so a frequent one is a row
    per task.
    """
    known = [F.col(c).isNull() for c in parent_key]
    nulls = parent.filter(F.greatest(*known) if len(known) > 1 else known[0])
    twice = parent.groupBy(*parent_key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    unset = [F.col(c).isNull() for c in child_key]
    loose = child.filter(F.greatest(*unset) if len(unset) > 1 else unset[0])
    used = child.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(child_key)]).distinct()
    there = parent.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(parent_key)])
    orphans = used.join(there, [f"__{i}" for i in range(len(child_key))], "left_anti")
    for rows, what in (
        (nulls, "a key without value"), (twice, "a repeated key"),
        (loose, "a row without reference"), (orphans, "a row whose reference is missing"),
    ):
        if not rows.isEmpty():
            raise BrokenReference(f"the tables have {what}")
    return Reference(
        tuple(child_key), tuple(parent_key), table_version(child), table_version(parent)
    )


class TrustedReferences:
    """Verified references, kept in a small file next to the tables."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _known(self) -> dict[str, dict]:
        text = read_file(self.spark, self.path)
        return json.loads(text) if text else {}

    def trust(self, name: str, reference: Reference) -> None:
        replace_file(self.spark, self.path, json.dumps({**self._known(), name: asdict(reference)}))

    def holds(self, name: str, child: DataFrame, parent: DataFrame) -> bool:
        """Whether the reference was verified for just these versions of both tables."""
        found = self._known().get(name)
        return (
            found is not None
            and found["child_version"] == table_version(child) != ""
            and found["parent_version"] == table_version(parent) != ""
        )

    def with_parent(
        self, name: str, child: DataFrame, child_key: Sequence[str], parent: DataFrame,
        parent_key: Sequence[str], columns: Sequence[str] = (),
    ) -> DataFrame:
        """Rows of ``child`` that have a parent, with the named parent columns.

        Without columns, a reference that is trusted for these versions needs no join at
        all; a stale or unknown one is not believed and becomes a semi join.
        """
        pairs = [F.col(a) == F.col(b) for a, b in zip(child_key, parent_key)]
        if not columns:
            found = self._known().get(name, {})
            same = tuple(found.get("child_key", ())) == tuple(child_key) and tuple(
                found.get("parent_key", ())
            ) == tuple(parent_key)
            if same and self.holds(name, child, parent):
                return child
            return child.join(parent.select(*parent_key), pairs, "left_semi")
        return child.join(parent.select(*parent_key, *columns), pairs).select(
            *child.columns, *columns
        )
