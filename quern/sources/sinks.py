"""Tables written from queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from quern.session import shared_folder


def create_table_as(
    df: DataFrame,
    name: str,
    path: str | None = None,
    replace: bool = False,
    compression: str | None = None,
) -> DataFrame:
    """Create table ``name`` with the rows and schema of ``df``.

    An existing table is an error unless ``replace`` is set: then the new rows are
    written in full under a draft name, which takes the old table's place, so a write
    that dies leaves the old table.  With ``path`` the table is external, and one that is
    replaced should get a new path: then only the catalog entry is exchanged.
    """
    spark = df.sparkSession
    draft = replace and spark.catalog.tableExists(name)
    target = f"{name}__draft" if draft else name
    if draft:
        spark.sql(f"DROP TABLE IF EXISTS {target}")
    writer = df.write.format("parquet").mode("errorifexists")
    if path is not None:
        writer = writer.option("path", path)
    if compression is not None:
        writer = writer.option("compression", compression)
    writer.saveAsTable(target)
    if draft:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {target} RENAME TO {name}")
    return spark.table(name)


def declare_table(
    spark: SparkSession, name: str, columns: str, path: str | None = None
) -> DataFrame:
    """Create an empty table from column DDL, replacing an older one.

    The DDL may give ``DEFAULT`` values, which fill columns that an insert omits.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    location = path or shared_folder(spark, f"table-{name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{location}'")
    return spark.table(name)


def insert_into(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Insert ``df`` into the listed columns, by position in the list.

    Columns of the table that are not listed take their default, or NULL.
    """
    spark = df.sparkSession
    target = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"INSERT INTO {name} ({target}) SELECT * FROM {{rows}}", rows=df)
    return spark.table(name)


def staged_copy(
    source: DataFrame, name: str, mapping: Mapping[str, str], columns: str
) -> DataFrame:
    """Load ``source`` into a declared table under new column names.

    ``mapping`` is target column → source column.  A row-store load goes through
    a staging table; here the projection feeds the insert directly, which writes
    the data once.
    """
    declare_table(source.sparkSession, name, columns)
    staged = source.select(*[source[old].alias(new) for new, old in mapping.items()])
    return insert_into(staged, name, list(mapping))
