"""Predicates: points, ranges, lists, patterns, NULLs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.dates import in_month, us_date
from quern.operators.domains import Domains, Interval, between, exactly
from quern.operators.filters import (
    equals_literal,
    has_rows,
    outside_range,
    text_contains,
    text_prefix,
    text_suffix,
)
from quern.plans.registry import query
from quern.sources.tables import Tables


@query("SELECT * FROM lineitem WHERE l_partkey = 776")
def filter_point(spark: SparkSession, t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_partkey") == 776)


@query(
    """
    SELECT * FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity = 10
    """
)
def filter_conj(spark: SparkSession, t: Tables) -> DataFrame:
    return t.lineitem.filter(
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "O")
        & (F.col("l_quantity") == 10)
    )


@query(
    """
    SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1998-04-01' AND TIMESTAMP '1998-07-01'
      AND o_orderpriority BETWEEN '1-URGENT' AND '3-MEDIUM'
      AND o_custkey BETWEEN 100 AND 1200
    """
)
def filter_between(spark: SparkSession, t: Tables) -> DataFrame:
    return t.orders.filter(
        F.col("o_orderdate").between(us_date("4/1/1998"), us_date("7/1/1998"))
        & F.col("o_orderpriority").between("1-URGENT", "3-MEDIUM")
        & F.col("o_custkey").between(100, 1200)
    ).select("o_orderkey", "o_orderdate", "o_orderpriority")


@query(
    """
    SELECT * FROM lineitem
    WHERE l_orderkey >= 1400 AND l_quantity < 5 AND l_discount > 0.05
      AND l_extendedprice <= 10000
    """
)
def filter_open_range(spark: SparkSession, t: Tables) -> DataFrame:
    return t.lineitem.filter(
        (F.col("l_orderkey") >= 1400)
        & (F.col("l_quantity") < 5)
        & (F.col("l_discount") > 0.05)
        & (F.col("l_extendedprice") <= 10000)
    )


@query("SELECT * FROM lineitem WHERE l_orderkey BETWEEN 42 AND 53")
def filter_in(spark: SparkSession, t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_orderkey").isin(*range(42, 54)))


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'blue%'")
def filter_prefix(spark: SparkSession, t: Tables) -> DataFrame:
    return t.part.filter(text_prefix(F.col("p_name"), "blue")).select(
        "p_partkey", "p_name"
    )


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE 'blue%'")
def filter_prefix_nocase(spark: SparkSession, t: Tables) -> DataFrame:
    return t.part.filter(text_prefix(F.col("p_name"), "BLUE", ignore_case=True)).select(
        "p_partkey", "p_name"
    )


@query("SELECT * FROM part WHERE p_name LIKE '%anvil'")
def filter_suffix(spark: SparkSession, t: Tables) -> DataFrame:
    return t.part.filter(text_suffix(F.col("p_name"), "anvil"))


@query("""SELECT page_id, url FROM pages WHERE html LIKE '%lang="fr"%'""")
def filter_contains(spark: SparkSession, t: Tables) -> DataFrame:
    return t.pages.filter(text_contains(F.col("html"), 'lang="fr"')).select("page_id", "url")


@query("SELECT * FROM orders WHERE o_orderkey * 2 = 3400")
def filter_expr(spark: SparkSession, t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderkey") * 2 == 3400)


@query("SELECT * FROM orders WHERE o_orderkey = 3400 // 2")
def filter_sargable(spark: SparkSession, t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderkey") == 3400 // 2)


@query("SELECT p_partkey, p_name FROM part WHERE left(p_name, 3) = 'sma'")
def filter_text_expr(spark: SparkSession, t: Tables) -> DataFrame:
    return t.part.filter(F.left("p_name", F.lit(3)) == "sma").select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'sma%'")
def filter_text_sargable(spark: SparkSession, t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_name").startswith("sma")).select("p_partkey", "p_name")


_MONTH_SQL = """
    SELECT o_orderkey, o_orderdate FROM orders
    JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_orderdate >= TIMESTAMP '1998-04-01' AND o_orderdate < TIMESTAMP '1998-05-01'
"""


@query(_MONTH_SQL)
def month_datepart(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t.orders.filter(
        (F.year("o_orderdate") == 1998) & (F.month("o_orderdate") == 4)
    )
    return orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_orderdate"
    )


@query(_MONTH_SQL)
def month_halfopen(spark: SparkSession, t: Tables) -> DataFrame:
    orders = t.orders.filter(in_month(F.col("o_orderdate"), 1998, 4))
    return orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_orderdate"
    )


def _status_or_null(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )


@query(
    """
    SELECT o_orderkey, status, 'range' AS kind
    FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)
    WHERE status < 'G' OR status >= 'P'
    UNION ALL
    SELECT o_orderkey, status, 'range or null'
    FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)
    WHERE status < 'G' OR status >= 'P' OR status IS NULL
    UNION ALL
    SELECT o_orderkey, status, 'set'
    FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)
    WHERE status IS NOT NULL
    """
)
def filter_null_range(spark: SparkSession, t: Tables) -> DataFrame:
    rows, status = _status_or_null(t), F.col("status")
    kinds = {
        "range": outside_range(status, "G", "P"),
        "range or null": outside_range(status, "G", "P", keep_null=True),
        "set": status.isNotNull(),
    }
    # One scan: each row is repeated for the predicates that it passes.
    passed = F.array_compact(
        F.array(*[F.when(p, F.lit(k)) for k, p in kinds.items()])
    )
    return rows.select("o_orderkey", "status", F.explode(passed).alias("kind"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = CAST('42' AS BIGINT)")
def filter_cast_literal(spark: SparkSession, t: Tables) -> DataFrame:
    return equals_literal(t.orders, "o_custkey", "42").select("o_orderkey", "o_custkey")


@query(
    """
    SELECT 'quantity 1' AS probe,
           EXISTS (SELECT 1 FROM lineitem WHERE l_quantity = 1) AS record_exists
    UNION ALL
    SELECT 'quantity 51', EXISTS (SELECT 1 FROM lineitem WHERE l_quantity = 51)
    """
)
def exists_flag(spark: SparkSession, t: Tables) -> DataFrame:
    found = [
        (f"quantity {q}", has_rows(t.lineitem.filter(F.col("l_quantity") == q)))
        for q in (1, 51)
    ]
    return spark.createDataFrame(found, "probe string, record_exists boolean")


@query(
    """
    SELECT 'inside' AS probe, count(*) AS n_rows FROM part
    WHERE p_size BETWEEN 10 AND 20 AND p_size = 20
    UNION ALL
    SELECT 'outside', count(*) FROM part WHERE p_size BETWEEN 10 AND 20 AND p_size = 30
    """
)
def filter_contradiction(spark: SparkSession, t: Tables) -> DataFrame:
    domain = t.part.filter(F.col("p_size").between(10, 20))
    probes = [
        domain.filter(F.col("p_size") == size)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(label).alias("probe"), "n_rows")
        for label, size in (("inside", 20), ("outside", 30))
    ]
    return probes[0].unionByName(probes[1])


@query("SELECT DISTINCT p_name FROM part")
def distinct_names(spark: SparkSession, t: Tables) -> DataFrame:
    return t.part.select("p_name").distinct()


@query(
    """
    SELECT 'inside' AS probe, count(*) AS n_rows FROM part WHERE p_size = 20
    UNION ALL SELECT 'outside', count(*) FROM part WHERE p_size = 60
    UNION ALL SELECT 'whole', count(*) FROM part WHERE p_size BETWEEN 0 AND 100
    UNION ALL SELECT 'edge', count(*) FROM part WHERE p_size >= 50 AND p_size < 90
    """
)
def domain_probe(spark: SparkSession, t: Tables) -> DataFrame:
    """Sizes are declared to lie between 1 and 50, which is verified first."""
    domains = Domains({"p_size": between(1, 50)}).verify(t.part)
    asked = {
        "inside": exactly(20),
        "outside": exactly(60),
        "whole": between(0, 100),
        "edge": Interval(50, 90, high_closed=False),
    }
    probes = [
        domains.filter(t.part, {"p_size": interval})
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(label).alias("probe"), "n_rows")
        for label, interval in asked.items()
    ]
    return reduce(DataFrame.unionByName, probes)
