"""Joins and lookups."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.numeric import sum_amount
from quern.operators.joins import (
    METHODS,
    join_by,
    latest_per_key,
    pair_with_few,
    where_key_exists,
)
from quern.operators.skew import skew_join
from quern.operators.trust import BrokenReference, TrustedReferences, verify_reference
from quern.plans.registry import query
from quern.plans.table_functions import register_table_functions
from quern.session import shared_folder
from quern.sources.tables import Tables


@query(
    """
    SELECT o_orderkey, o_orderdate, l_linenumber, l_quantity, l_extendedprice
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """
)
def join_two(spark: SparkSession, t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_orderdate", "l_linenumber", "l_quantity", "l_extendedprice"
    )


@query(
    """
    SELECT o_orderkey, o_custkey, l_extendedprice, l_quantity, p_retailprice, p_name
    FROM orders
    JOIN lineitem ON o_orderkey = l_orderkey
    JOIN part ON l_partkey = p_partkey
    WHERE l_extendedprice > 100000
    """
)
def join_star3(spark: SparkSession, t: Tables) -> DataFrame:
    return (
        t.lineitem.filter(F.col("l_extendedprice") > 100000)
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "o_orderkey", "o_custkey", "l_extendedprice", "l_quantity",
            "p_retailprice", "p_name",
        )
    )


@query(
    """
    SELECT o_orderkey, p_name, s_name, n_name, r_name, l_discount, l_quantity
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA' AND l_discount > .09
    """
)
def join_star5(spark: SparkSession, t: Tables) -> DataFrame:
    # The filtered end of the chain is joined first: it thins out the lines
    # before they meet the two large tables.
    sellers = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(F.col("r_name") == "ASIA")
    )
    return (
        t.lineitem.filter(F.col("l_discount") > 0.09)
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "o_orderkey", "p_name", "s_name", "n_name", "r_name", "l_discount",
            "l_quantity",
        )
    )


@query(
    """
    WITH pairs AS (
        SELECT l_partkey AS pk, l_suppkey AS sk, count(*) AS pair_lines,
               max(l_quantity) AS max_quantity
        FROM lineitem GROUP BY l_partkey, l_suppkey)
    SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, pair_lines, max_quantity
    FROM lineitem JOIN pairs ON l_partkey = pk AND l_suppkey = sk
    """
)
def join_composite(spark: SparkSession, t: Tables) -> DataFrame:
    offers = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("pair_lines"), F.max("l_quantity").alias("max_quantity")
    )
    return (
        t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
        .join(offers, ["l_partkey", "l_suppkey"])
    )


_SKEW_SQL = """
    WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey = 42 THEN 1 ELSE 2 END AS c FROM orders),
         b AS (SELECT event_id, CASE WHEN event_id = 42 THEN 2 ELSE 1 END AS d FROM events)
    SELECT c, o_orderkey, event_id FROM a JOIN b ON c = d {where}
"""


def _opposite_skew(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Key 1 is rare on the left and frequent on the right, key 2 the reverse.

    The rare row is picked by a unique column, so each key has one row on one
    side and the result grows with the tables, not with their product.
    """
    left = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") == 42, 1).otherwise(2).alias("c")
    )
    right = t.events.select(
        "event_id", F.when(F.col("event_id") == 42, 2).otherwise(1).alias("d")
    )
    return left, right


@query(_SKEW_SQL.format(where=""))
def join_skew(spark: SparkSession, t: Tables) -> DataFrame:
    """The few rows of a frequent key's other side go to the tasks that read its many.

    Tables too small for that are left to adaptive execution, which splits the
    partition of a frequent key by map task; it goes by compressed bytes, so it would
    let millions of such narrow rows meet in one task.
    """
    left, right = _opposite_skew(t)
    return skew_join(left, right, ["c"], ["d"]).select("c", "o_orderkey", "event_id")


@query(_SKEW_SQL.format(where="WHERE c = 2"))
def join_skew_one_key(spark: SparkSession, t: Tables) -> DataFrame:
    """One key only, so it is filtered on both sides before the join.

    For a computed key the optimizer does not carry the filter over by itself.
    What is left of the rare side is small, and is broadcast once it has been counted.
    """
    left, right = _opposite_skew(t)
    both = skew_join(
        left.filter(F.col("c") == 2), right.filter(F.col("d") == 2), ["c"], ["d"]
    )
    return both.select("c", "o_orderkey", "event_id")


@query(
    """
    SELECT l_orderkey, l_partkey, p_name, p_size
    FROM lineitem JOIN part ON l_partkey = p_partkey AND p_size = 20
    """
)
def join_on_const(spark: SparkSession, t: Tables) -> DataFrame:
    on = (F.col("l_partkey") == F.col("p_partkey")) & (F.col("p_size") == 20)
    return t.lineitem.join(t.part, on).select(
        "l_orderkey", "l_partkey", "p_name", "p_size"
    )


@query(
    """
    SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, l_shipdate
    FROM (SELECT *, max(l_orderkey) OVER (PARTITION BY l_partkey) AS latest FROM lineitem)
    WHERE l_orderkey = latest AND l_partkey IS NOT NULL
      AND l_shipdate > TIMESTAMP '1998-01-01'
    """
)
def latest_per_part(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    since = F.lit(datetime(1998, 1, 1)).cast("timestamp_ntz")
    return latest_per_key(rows, "l_partkey", "l_orderkey").filter(
        F.col("l_shipdate") > since
    )


@query("SELECT p_partkey, p_name, r_regionkey, r_name FROM part CROSS JOIN region")
def cross_small(spark: SparkSession, t: Tables) -> DataFrame:
    return pair_with_few(t.part.select("p_partkey", "p_name"), t.region)


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """
)
def join_fk_only(spark: SparkSession, t: Tables) -> DataFrame:
    return where_key_exists(
        t.orders.select("o_orderkey", "o_custkey"),
        t.lineitem.select("l_orderkey"),
        F.col("o_orderkey") == F.col("l_orderkey"),
    )


@query(
    """
    SELECT method, count(*) AS n_rows,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100.0 AS DECIMAL(28,2)) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey
    CROSS JOIN (VALUES ('broadcast'), ('merge'), ('shuffle_hash')) AS m(method)
    GROUP BY method
    """
)
def join_hints(spark: SparkSession, t: Tables) -> DataFrame:
    on = F.col("o_custkey") == F.col("c_custkey")
    parts = [
        join_by(t.orders, t.customer, on, method)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            sum_amount(F.col("o_totalprice")).alias("total"),
        )
        .select(F.lit(method).alias("method"), "n_rows", "total")
        for method in METHODS
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    """
    SELECT c_custkey, c_name, o_orderkey AS order_id, o_totalprice AS amount
    FROM customer JOIN orders ON o_custkey = c_custkey
    """
)
def apply_lateral(spark: SparkSession, t: Tables) -> DataFrame:
    register_table_functions(spark, t)
    return spark.sql(
        """
        SELECT c_custkey, c_name, f.order_id, f.amount
        FROM {customer}, LATERAL orders_of(c_custkey) AS f
        """,
        customer=t.customer,
    )


@query(
    """
    SELECT o_orderkey, l_partkey AS line_part, l_quantity AS quantity
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    """
)
def apply_lateral_outer(spark: SparkSession, t: Tables) -> DataFrame:
    register_table_functions(spark, t)
    return spark.sql(
        """
        SELECT o_orderkey, f.line_part, f.quantity
        FROM {orders} LEFT JOIN LATERAL lines_of(o_orderkey) AS f
        """,
        orders=t.orders,
    )


@query(
    """
    SELECT l_suppkey, count(*) AS n_rows, count(o_orderkey) AS n_pairs,
           CAST(sum(o_orderkey) AS BIGINT) AS order_sum
    FROM lineitem LEFT JOIN orders ON o_custkey = l_suppkey GROUP BY l_suppkey
    """
)
def join_skew_both(spark: SparkSession, t: Tables) -> DataFrame:
    """Frequent keys on both sides, cut into fragments that meet pairwise."""
    lines = t.lineitem.select("l_suppkey")
    bought = t.orders.select("o_custkey", "o_orderkey")
    return (
        skew_join(lines, bought, ["l_suppkey"], ["o_custkey"], "left")
        .groupBy("l_suppkey")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("o_orderkey").alias("n_pairs"),
            F.sum("o_orderkey").alias("order_sum"),
        )
    )


@query(
    """
    SELECT o_custkey, o_orderkey, o_orderdate FROM orders
    WHERE o_custkey IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
    """
)
def latest_order(spark: SparkSession, t: Tables) -> DataFrame:
    """The key is unique among a customer's orders, so one pass is enough."""
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_per_key(rows, "o_custkey", "o_orderkey", unique=True)


@query("SELECT o_orderkey, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey")
def join_trusted(spark: SparkSession, t: Tables) -> DataFrame:
    """Orders with a customer; where the reference was verified, without a join."""
    known = TrustedReferences(spark, shared_folder(spark, "references") + ".json")
    key, parent_key = ["o_custkey"], ["c_custkey"]
    orders = t.orders.select("o_orderkey", "o_custkey")
    customers = t.customer.select("c_custkey")
    try:
        known.trust("customer", verify_reference(orders, key, customers, parent_key))
    except BrokenReference:
        pass  # orders without a customer: the semi join drops them
    return known.with_parent("customer", orders, key, customers, parent_key)
