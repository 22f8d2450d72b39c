"""Compare a Spark result with DuckDB on the same parquet files."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return f"d{value}"
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
    "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    "float": "FLOAT", "timestamp": "TIMESTAMP WITH TIME ZONE", "binary": "BLOB",
}


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, types and rows agree."""
    relation = con.sql(sql)
    found = []
    mine = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(mine) != sorted(theirs):
        return [f"columns {sorted(mine)} != {sorted(theirs)}"]
    for name, kind in mine.items():
        expected = _KINDS.get(kind, kind.upper().replace(" ", ""))
        if expected != theirs[name].replace(" ", "") and expected != theirs[name]:
            found.append(f"type of {name}: {kind} != {theirs[name]}")
    left = _bag(list(mine), [tuple(r) for r in df.collect()])
    right = _bag(list(theirs), relation.fetchall())
    if left != right:
        only_left = list((left - right).items())[:3]
        only_right = list((right - left).items())[:3]
        found.append(
            f"{sum(left.values())} rows != {sum(right.values())}; "
            f"only here {only_left}; only there {only_right}"
        )
    if not sum(right.values()):
        found.append("no rows")
    return found
