"""Scans, generated rows, written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.numeric import cents, cents_to_amount, whole_quotient
from quern.plans.registry import query
from quern.session import shared_folder
from quern.sources.generators import generate, numbers, skewed_pair, with_dense_id
from quern.sources.literals import append_rows, literal_rows
from quern.sources.sinks import (
    create_table_as,
    declare_table,
    insert_into,
    staged_copy as load_staged,
)
from quern.sources.tables import Tables, scan


@query("SELECT * FROM orders")
def scan_all(spark: SparkSession, t: Tables) -> DataFrame:
    return scan(spark, f"{t.folder}/orders.parquet")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def scan_narrow(spark: SparkSession, t: Tables) -> DataFrame:
    return scan(
        spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"]
    )


@query(
    """
    SELECT v.status_text, count(*) AS n_orders
    FROM (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending'), ('X', 'unused'))
         AS v(status_code, status_text)
    JOIN orders ON o_orderstatus = v.status_code
    GROUP BY v.status_text
    """,
    name="literal_rows",
)
def status_texts(spark: SparkSession, t: Tables) -> DataFrame:
    texts = literal_rows(
        spark,
        "status_code string, status_text string",
        [("F", "finished"), ("O", "open"), ("P", "pending"), ("X", "unused")],
    )
    per_status = t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    return per_status.join(
        texts, F.col("o_orderstatus") == F.col("status_code")
    ).select("status_text", "n_orders")


@query("SELECT * FROM part")
def ctas_copy(spark: SparkSession, t: Tables) -> DataFrame:
    path = shared_folder(spark, "part-copy")
    return create_table_as(t.part, "quern_part_copy", path, replace=True)


@query(
    """
    SELECT c_mktsegment AS segment, c_name AS buyer, c_nationkey AS state_id,
           c_custkey AS buyer_id, CAST(NULL AS VARCHAR) AS second_line
    FROM customer
    """
)
def staged_copy(spark: SparkSession, t: Tables) -> DataFrame:
    return load_staged(
        t.customer,
        "quern_buyers",
        {
            "buyer_id": "c_custkey",
            "buyer": "c_name",
            "state_id": "c_nationkey",
            "segment": "c_mktsegment",
        },
        "segment string, buyer string, second_line string, state_id int, buyer_id bigint",
    )


@query(
    """
    SELECT s_suppkey, s_name, TIMESTAMP '2014-06-01 00:00:00' AS loaded_at
    FROM supplier
    """
)
def insert_default(spark: SparkSession, t: Tables) -> DataFrame:
    # A load would default to current_timestamp(); a fixed instant can be compared.
    declare_table(
        spark,
        "quern_supplier_load",
        "s_suppkey bigint, s_name string, "
        "loaded_at timestamp_ntz DEFAULT TIMESTAMP_NTZ '2014-06-01 00:00:00'",
    )
    rows = t.supplier.select("s_suppkey", "s_name")
    return insert_into(rows, "quern_supplier_load", ["s_suppkey", "s_name"])


@query(
    "SELECT unnest(generate_series(1, (SELECT count(*) FROM orders))) AS n",
    name="numbers",
)
def order_numbers(spark: SparkSession, t: Tables) -> DataFrame:
    return numbers(spark, t.orders.count())


@query(
    """
    SELECT n AS id, CASE WHEN n = 1 THEN 1 ELSE 2 END AS value
    FROM (SELECT unnest(generate_series(1, (SELECT count(*) FROM lineitem) + 1)) AS n)
    """
)
def gen_skew(spark: SparkSession, t: Tables) -> DataFrame:
    return skewed_pair(spark, t.lineitem.count(), single=1, frequent=2)


@query(
    """
    SELECT n, CAST(2 AS INTEGER) AS fixed, n % 50 AS mod50,
           CAST(n % 256 AS SMALLINT) AS mod256, 41 - n AS mirrored,
           n * 100 AS hundreds, n // 2 AS half, 'UniqueKey' || n AS text_key
    FROM (SELECT unnest(generate_series(1, (SELECT count(*) FROM lineitem))) AS n)
    """
)
def gen_mod(spark: SparkSession, t: Tables) -> DataFrame:
    n = F.col("n")
    return generate(
        spark,
        t.lineitem.count(),
        n=n,
        fixed=F.lit(2),
        mod50=n % 50,
        mod256=(n % 256).cast("smallint"),
        mirrored=41 - n,
        hundreds=n * 100,
        half=whole_quotient(n, F.lit(2)),
        text_key=F.concat(F.lit("UniqueKey"), n.cast("string")),
    )


@query(
    """
    SELECT row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS id,
           o_orderkey, o_orderdate
    FROM orders
    """
)
def dense_id(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return with_dense_id(rows, ["o_orderdate", "o_orderkey"])


@query(
    """
    SELECT row_number() OVER (ORDER BY l_shipdate NULLS FIRST, l_orderkey NULLS FIRST,
               l_linenumber NULLS FIRST, l_quantity NULLS FIRST) AS id,
           l_shipdate, l_orderkey, l_linenumber, l_quantity
    FROM lineitem
    """
)
def dense_id_keyless(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    return with_dense_id(rows, ["l_shipdate"], unique=False)


@query(
    """
    WITH revenue AS (
        SELECT l_partkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS c
        FROM lineitem GROUP BY l_partkey)
    SELECT l_partkey, CAST(c / 100.0 AS DECIMAL(28,2)) AS revenue
    FROM revenue
    WHERE c * (SELECT count(*) FROM revenue) > (SELECT sum(c) FROM revenue)
    """
)
def temp_reuse(spark: SparkSession, t: Tables) -> DataFrame:
    # The named frame is read three times but its shuffle runs once (exchange reuse).
    revenue = t.lineitem.groupBy("l_partkey").agg(
        F.sum(cents(F.col("l_extendedprice"))).alias("c")
    )
    wide = F.col("c").cast("decimal(38,0)")
    totals = revenue.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(wide).alias("s")))
    return revenue.withColumn("all", totals.scalar()).filter(
        wide * F.col("all.n") > F.col("all.s")
    ).select("l_partkey", cents_to_amount(F.col("c")).alias("revenue"))


@query(
    """
    SELECT p_partkey, p_name, p_size, p_retailprice FROM part
    UNION ALL VALUES (-1, 'sample bolt', 7, NULL), (-2, 'sample gear', 9, NULL)
    """
)
def append_literal(spark: SparkSession, t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    return append_rows(
        parts,
        ["p_partkey", "p_name", "p_size"],
        [(-1, "sample bolt", 7), (-2, "sample gear", 9)],
    )
