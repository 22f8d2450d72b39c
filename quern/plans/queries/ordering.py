"""Numbering, sorting, limits, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.ranking import sort_columns, top_numbered, top_with_position
from quern.plans.registry import query
from quern.sources.tables import Tables

_BY_NAME = [("p_name", True), ("p_partkey", False)]
_BY_PRICE = [("p_retailprice", True), ("p_partkey", False)]


@query(
    """
    SELECT p_partkey, p_name, p_retailprice, p_size,
           row_number() OVER (ORDER BY p_name DESC NULLS LAST, p_partkey NULLS FIRST) AS row_number
    FROM part ORDER BY p_name DESC NULLS LAST, p_partkey NULLS FIRST LIMIT 10
    """
)
def topk_numbered(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_name", "p_retailprice", "p_size")
    return top_numbered(rows, _BY_NAME, 10)


@query(
    """
    SELECT p_partkey, p_name, p_retailprice, p_size,
           row_number() OVER (ORDER BY p_name DESC NULLS LAST, p_partkey NULLS FIRST) AS row_number
    FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey NULLS FIRST LIMIT 10
    """
)
def topk_other_rank(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_name", "p_retailprice", "p_size")
    return top_with_position(rows, _BY_PRICE, 10, _BY_NAME)


@query(
    """
    SELECT c_custkey, c_nationkey, c_acctbal FROM customer
    ORDER BY c_nationkey NULLS FIRST, c_acctbal DESC NULLS LAST, c_custkey
    """
)
def sort_multi(spark: SparkSession, t: Tables) -> DataFrame:
    # The unique key at the end also keeps rows of one nation spread over tasks.
    terms = [("c_nationkey", False), ("c_acctbal", True), ("c_custkey", False)]
    return t.customer.select("c_custkey", "c_nationkey", "c_acctbal").orderBy(
        *sort_columns(terms)
    )


@query(
    """
    SELECT event_id, event_type, value FROM events
    ORDER BY value DESC NULLS LAST, event_id LIMIT 10
    """
)
def topk(spark: SparkSession, t: Tables) -> DataFrame:
    return (
        t.events.select("event_id", "event_type", "value")
        .orderBy(F.col("value").desc_nulls_last(), "event_id")
        .limit(10)
    )


@query(
    """
    SELECT count(*) AS n_rows, count(p_partkey) AS n_known
    FROM (SELECT * FROM part LIMIT 100)
    """
)
def limit_any(spark: SparkSession, t: Tables) -> DataFrame:
    # Which rows come is arbitrary, so their number and origin are reported.
    some = t.part.limit(100).select(F.col("p_partkey").alias("some_key"))
    return some.join(
        t.part.select("p_partkey"), F.col("some_key") == F.col("p_partkey"), "left"
    ).agg(F.count("some_key").alias("n_rows"), F.count("p_partkey").alias("n_known"))


def _two_parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    lines = t.lineitem.select("l_partkey", "l_linenumber")
    return (
        lines.filter(F.col("l_partkey") == 777),
        lines.filter(F.col("l_partkey") == 776),
    )


@query(
    """
    SELECT l_partkey, l_linenumber FROM lineitem WHERE l_partkey = 777
    UNION
    SELECT l_partkey, l_linenumber FROM lineitem WHERE l_partkey = 776
    """
)
def union_distinct(spark: SparkSession, t: Tables) -> DataFrame:
    first, second = _two_parts(t)
    return first.union(second).distinct()


@query(
    """
    SELECT l_partkey, l_linenumber FROM lineitem WHERE l_partkey = 777
    UNION ALL
    SELECT l_partkey, l_linenumber FROM lineitem WHERE l_partkey = 776
    """
)
def union_all(spark: SparkSession, t: Tables) -> DataFrame:
    first, second = _two_parts(t)
    return first.unionByName(second)
