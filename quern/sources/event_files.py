"""Captured events in text files, one XML document per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quern.functions.xml import EVENT_SCHEMA, escape, event_xml


def write_event_lines(
    df: DataFrame, path: str, name: Column, fields: dict[str, Column]
) -> str:
    """Write one event per row of ``df``; a NULL field leaves its node out."""
    typed = df.select(
        name.alias("__name"), *[value.alias(f) for f, value in fields.items()]
    )
    # Only text can hold characters that XML reserves.
    nodes = {
        f: escape(F.col(f)) if isinstance(typed.schema[f].dataType, StringType) else F.col(f)
        for f in fields
    }
    event = event_xml(escape(F.col("__name")), nodes)
    typed.select(event.alias("value")).write.text(path)
    return path


def read_event_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """Raw payloads of all files that match ``pattern``, in column ``payload``."""
    return spark.read.text(pattern).select(F.col("value").alias("payload"))


def read_event_documents(spark: SparkSession, pattern: str) -> DataFrame:
    """Parsed events of files whose events span lines, in column ``event``.

    Each file must be one XML document: the events need an enclosing element, for
    a reader stops at the end of the first top-level element.
    """
    rows = spark.read.format("xml").option("rowTag", "event").schema(EVENT_SCHEMA)
    return rows.load(pattern).select(F.struct("_name", "data").alias("event"))
