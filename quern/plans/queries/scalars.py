"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.numeric import MONEY, rounded_int, whole_quotient
from quern.functions.text import fixed_width, join_text, visible_length
from quern.plans.registry import query
from quern.plans.telemetry import by_event
from quern.sources.tables import Tables


@query(
    """
    SELECT p_partkey, substring(p_name, 1, 1) AS first_char, left(p_name, 3) AS start_text,
           length(p_name) AS visible, length(rpad(p_name, 20, ' ')) AS stored,
           p_brand || ': ' || p_name AS label
    FROM part
    """
)
def scalar_text(spark: SparkSession, t: Tables) -> DataFrame:
    name, padded = F.col("p_name"), fixed_width(F.col("p_name"), 20)
    return t.part.select(
        "p_partkey",
        F.substring(name, 1, 1).alias("first_char"),
        F.left(name, F.lit(3)).alias("start_text"),
        visible_length(padded).cast("bigint").alias("visible"),
        F.length(padded).cast("bigint").alias("stored"),
        join_text(F.col("p_brand"), F.lit(": "), name).alias("label"),
    )


@query(
    """
    SELECT o_orderkey, 'a' || nullif(o_orderstatus, 'P') || 'b' AS null_wins,
           concat_ws('', 'a', nullif(o_orderstatus, 'P'), 'b') AS null_is_empty,
           nullif(o_orderstatus, 'P') IS NOT DISTINCT FROM NULL AS equals_null
    FROM orders
    """
)
def null_concat(spark: SparkSession, t: Tables) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("P"))
    parts = (F.lit("a"), status, F.lit("b"))
    return t.orders.select(
        "o_orderkey",
        join_text(*parts).alias("null_wins"),
        join_text(*parts, null_wins=False).alias("null_is_empty"),
        status.eqNullSafe(F.lit(None)).alias("equals_null"),
    )


@query(
    """
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text,
           CAST(o_custkey AS DECIMAL(18,0)) AS customer_decimal,
           left(CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS VARCHAR), 6) AS price_text,
           CAST(round(o_totalprice) AS INTEGER) AS price_int
    FROM orders
    """
)
def scalar_cast(spark: SparkSession, t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_custkey").cast("decimal(18,0)").alias("customer_decimal"),
        F.left(price.cast(MONEY).cast("string"), F.lit(6)).alias("price_text"),
        rounded_int(price).alias("price_int"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_orderkey + 1 AS plus_one, l_orderkey - 10 AS minus_ten,
           l_orderkey * 2 AS doubled, l_orderkey % 50 AS remainder,
           l_orderkey // 2 AS whole_half, l_orderkey / 2 AS exact_half
    FROM lineitem
    """
)
def scalar_math(spark: SparkSession, t: Tables) -> DataFrame:
    key = F.col("l_orderkey")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (key + 1).alias("plus_one"),
        (key - 10).alias("minus_ten"),
        (key * 2).alias("doubled"),
        (key % 50).alias("remainder"),
        whole_quotient(key, F.lit(2)).alias("whole_half"),
        (key / 2).alias("exact_half"),
    )


@query(
    """
    SELECT event_id, event_type,
           CASE event_type WHEN 'purchase' THEN props WHEN 'error' THEN 'user ' || user_id END
               AS event_text,
           CASE WHEN value > 40 THEN 'high' WHEN value > 10 THEN 'middle' ELSE 'low' END AS level
    FROM events
    """
)
def event_text(spark: SparkSession, t: Tables) -> DataFrame:
    value = F.col("value")
    choices = {
        "purchase": F.col("props"),
        "error": F.concat(F.lit("user "), F.col("user_id").cast("string")),
    }
    return t.events.select(
        "event_id",
        "event_type",
        by_event(F.col("event_type"), choices).alias("event_text"),
        F.when(value > 40, "high").when(value > 10, "middle").otherwise("low").alias("level"),
    )
