"""Base tables stored as parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def scan(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Read a table; with ``columns`` only those reach the parquet reader."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


class Tables:
    """Attribute access to tables: ``Tables(spark, folder).orders``.

    The tables are parquet files in one folder or, with ``database``, tables of
    that database in the session's catalog.
    """

    def __init__(
        self, spark: SparkSession, folder: str = "", database: str | None = None
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.database = database
        self._frames: dict[str, DataFrame] = {}

    def _load(self, name: str) -> DataFrame:
        if self.database is not None:
            return self.spark.table(f"{self.database}.{name}")
        return scan(self.spark, f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def register(self, *names: str, prefix: str = "") -> None:
        """Expose tables to ``spark.sql`` as temporary views."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(prefix + name)
