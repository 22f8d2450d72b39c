"""Copies of the tables with a frequent key, repeated rows or missing values."""

from __future__ import annotations

import os

import duckdb
from oracle import TABLES

# A third of the rows get one key; some rows become exact copies.
HOT = {
    "lineitem": """
        SELECT * EXCLUDE (rn) REPLACE (
            CASE WHEN rn % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey,
            CASE WHEN rn % 3 = 1 THEN 42 ELSE l_orderkey END AS l_orderkey) FROM t
        UNION ALL SELECT * EXCLUDE (rn, range) FROM t, range(50) WHERE rn = 5""",
    "orders": """
        SELECT * EXCLUDE (rn) REPLACE (
            CASE WHEN rn % 3 = 0 THEN 42 ELSE o_custkey END AS o_custkey,
            CASE WHEN rn % 3 = 1 THEN 'F' ELSE o_orderstatus END AS o_orderstatus) FROM t""",
    "part": """
        SELECT * EXCLUDE (rn) REPLACE (
            CASE WHEN rn % 3 = 0 THEN 'blue anvil' ELSE p_name END AS p_name) FROM t""",
    "customer": """
        SELECT * EXCLUDE (rn) REPLACE (
            CASE WHEN rn % 3 = 0 THEN 10 ELSE c_nationkey END AS c_nationkey) FROM t""",
    "events": """
        SELECT * EXCLUDE (rn) REPLACE (
            CASE WHEN rn % 3 = 0 THEN 42 ELSE user_id END AS user_id,
            CASE WHEN rn % 3 = 0 THEN '{}' ELSE props END AS props) FROM t""",
}

# Every seventh value of these columns is missing.
NULLS = {
    "lineitem": "l_orderkey l_partkey l_suppkey l_quantity l_returnflag l_shipdate"
    " l_extendedprice l_discount".split(),
    "orders": "o_custkey o_orderstatus o_orderdate o_totalprice".split(),
    "part": "p_name p_size p_retailprice p_type".split(),
    "customer": "c_nationkey c_mktsegment c_name c_acctbal".split(),
    "supplier": ["s_nationkey"],
    "events": "user_id props value event_type".split(),
}


def build(source: str, target: str, kind: str) -> str:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(target, f"{table}.parquet")
        query = "SELECT * EXCLUDE (rn) FROM t"
        if kind == "hot" and table in HOT:
            query = HOT[table]
        if kind == "nulls" and table in NULLS:
            parts = ", ".join(
                f"CASE WHEN rn % 7 <> {i % 7} THEN {c} END AS {c}"
                for i, c in enumerate(NULLS[table])
            )
            query = f"SELECT * EXCLUDE (rn) REPLACE ({parts}) FROM t"
        con.execute(
            f"CREATE OR REPLACE TABLE t AS SELECT *, row_number() OVER () AS rn"
            f" FROM '{source}/{table}.parquet'"
        )
        con.execute(f"COPY ({query}) TO '{path}' (FORMAT parquet)")
    return target
