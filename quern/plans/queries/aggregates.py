"""Grouped and scalar aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.numeric import average_amount, cents, sum_amount
from quern.operators.aggregates import (
    footer_extremes,
    prefix_density,
    rollup_then_lookup,
    selectivity as column_selectivity,
)
from quern.operators.filters import text_prefix
from quern.operators.maintained import apply_delta, build_view
from quern.plans.registry import query
from quern.session import shared_folder
from quern.sources.tables import Tables

def _quantities() -> dict[str, Column]:
    quantity, returned = F.col("l_quantity").cast("bigint"), F.col("l_returnflag") == "R"
    return {
        "order_qty": F.sum(quantity),
        "received_qty": F.sum(F.when(~returned, quantity).otherwise(0)),
        "rejected_qty": F.sum(F.when(returned, quantity).otherwise(0)),
    }


_QUANTITY_SQL = """
           CAST(sum(l_quantity) AS BIGINT) AS order_qty,
           CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS BIGINT)
               AS received_qty,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT)
               AS rejected_qty
"""


def _per_name(lines: DataFrame, parts: DataFrame) -> DataFrame:
    return rollup_then_lookup(
        lines, "l_partkey", _quantities(), parts, "p_partkey", ["p_name"]
    )


@query(
    f"""
    SELECT p_name, {_QUANTITY_SQL}
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
    """
)
def product_qty(spark: SparkSession, t: Tables) -> DataFrame:
    return _per_name(t.lineitem, t.part.select("p_partkey", "p_name"))


@query(
    f"""
    SELECT p_name, {_QUANTITY_SQL}
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_name LIKE 'blue%' GROUP BY p_name
    """
)
def product_qty_prefix(spark: SparkSession, t: Tables) -> DataFrame:
    wanted = t.part.filter(text_prefix(F.col("p_name"), "blue")).select(
        "p_partkey", "p_name"
    )
    # The few parts thin out the lines before they are grouped.
    lines = t.lineitem.join(
        wanted, F.col("l_partkey") == F.col("p_partkey"), "left_semi"
    )
    return _per_name(lines, wanted)


@query(
    f"""
    SELECT p_name, {_QUANTITY_SQL}
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
    HAVING CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS DECIMAL(18,4))
           / CAST(sum(l_quantity) AS DECIMAL(18,4)) > .34
    """
)
def reject_ratio(spark: SparkSession, t: Tables) -> DataFrame:
    share = F.col("rejected_qty").cast("decimal(18,4)") / F.col("order_qty")
    return product_qty(spark, t).filter(share > 0.34)


@query(
    """
    SELECT l_partkey, count(l_partkey) AS n_lines,
           CAST(sum(l_quantity) AS BIGINT) AS sum_quantity,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT)
               / nullif(count(l_extendedprice) * 100, 0)::DOUBLE AS avg_price
    FROM lineitem GROUP BY l_partkey
    """
)
def history_rollup(spark: SparkSession, t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_partkey").agg(
        F.count("l_partkey").alias("n_lines"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("sum_quantity"),
        average_amount(F.col("l_extendedprice")).alias("avg_price"),
    )


@query(
    """
    SELECT c_nationkey, c_mktsegment, count(*) AS n_customers
    FROM customer GROUP BY c_nationkey, c_mktsegment HAVING count(*) = 12
    """
)
def having_count(spark: SparkSession, t: Tables) -> DataFrame:
    return (
        t.customer.groupBy("c_nationkey", "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n_customers"))
        .filter(F.col("n_customers") == 12)
    )


@query(
    """
    SELECT p_name,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT)
               / nullif(count(l_extendedprice) * 100, 0)::DOUBLE AS avg_price
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_partkey = 776
    GROUP BY l_suppkey, p_name
    HAVING max(l_quantity) > 1
    ORDER BY min(l_extendedprice)
    """
)
def hidden_aggs(spark: SparkSession, t: Tables) -> DataFrame:
    return (
        t.lineitem.filter(F.col("l_partkey") == 776)
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_suppkey", "p_name")
        .agg(
            average_amount(F.col("l_extendedprice")).alias("avg_price"),
            F.max("l_quantity").alias("most"),
            F.min("l_extendedprice").alias("least"),
        )
        .filter(F.col("most") > 1)
        .orderBy("least")
        .select("p_name", "avg_price")
    )


@query(
    """
    SELECT min(l_extendedprice) AS lowest_price, count(*) AS n_lines,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 100.0 AS DECIMAL(28,2))
               AS total_price
    FROM lineitem
    """
)
def scalar_min(spark: SparkSession, t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.min("l_extendedprice").alias("lowest_price"),
        F.count(F.lit(1)).alias("n_lines"),
        sum_amount(F.col("l_extendedprice")).alias("total_price"),
    )


@query(
    """
    SELECT min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest,
           count(*) AS n_rows
    FROM lineitem
    """
)
def scalar_min_footer(spark: SparkSession, t: Tables) -> DataFrame:
    return footer_extremes(spark, f"{t.folder}/lineitem.parquet", "l_extendedprice")


@query(
    """
    SELECT count(DISTINCT o_orderstatus) AS distinct_values, count(o_orderstatus) AS n_rows,
           CAST(count(DISTINCT o_orderstatus) / count(o_orderstatus)::DOUBLE AS DECIMAL(18,8))
               AS selectivity,
           CAST(1.0::DOUBLE / count(DISTINCT o_orderstatus) AS DECIMAL(18,8)) AS density
    FROM orders
    """
)
def selectivity(spark: SparkSession, t: Tables) -> DataFrame:
    return column_selectivity(t.orders, "o_orderstatus")


@query(
    """
    SELECT 'o_orderstatus' AS key_columns, count(*) AS distinct_values,
           CAST(1.0::DOUBLE / count(*) AS DECIMAL(18,8)) AS density
    FROM (SELECT DISTINCT o_orderstatus FROM orders)
    UNION ALL
    SELECT 'o_orderstatus, o_orderpriority', count(*),
           CAST(1.0::DOUBLE / count(*) AS DECIMAL(18,8))
    FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders)
    """
)
def density_pair(spark: SparkSession, t: Tables) -> DataFrame:
    return prefix_density(t.orders, ["o_orderstatus", "o_orderpriority"])


_FOUR = ["l_returnflag", "l_linenumber", "l_quantity", "l_suppkey"]


@query(
    " UNION ALL ".join(
        f"""
        SELECT '{', '.join(_FOUR[:n])}' AS key_columns, count(*) AS distinct_values,
               CAST(1.0::DOUBLE / count(*) AS DECIMAL(18,8)) AS density
        FROM (SELECT DISTINCT {', '.join(_FOUR[:n])} FROM lineitem)
        """
        for n in range(1, 5)
    )
)
def density_four(spark: SparkSession, t: Tables) -> DataFrame:
    return prefix_density(t.lineitem, _FOUR)


_VIEW_KEYS = ["l_partkey"]


def _view_sums() -> dict[str, Column]:
    return {
        "sum_qty": F.col("l_quantity").cast("bigint"),
        "sum_cents": cents(F.col("l_extendedprice")),
    }


_VIEW_SQL = """
    SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS sum_qty,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sum_cents,
           count(*) AS n_rows
    FROM lineitem {where} GROUP BY l_partkey
"""


@query(_VIEW_SQL.format(where=""))
def agg_view(spark: SparkSession, t: Tables) -> DataFrame:
    path = shared_folder(spark, "agg-view")
    build_view(t.lineitem, _VIEW_KEYS, _view_sums()).write.parquet(path)
    return spark.read.parquet(path)


_LEFT_OVER = "WHERE l_returnflag IN ('N', 'R') AND l_partkey IS DISTINCT FROM 776"


@query(_VIEW_SQL.format(where=_LEFT_OVER))
def agg_view_delta(spark: SparkSession, t: Tables) -> DataFrame:
    """View over flags N and A; then R lines arrive, A lines and part 776 leave."""
    flag, part = F.col("l_returnflag"), F.col("l_partkey")
    loaded = t.lineitem.filter(flag.isin("N", "A", "R"))
    path = shared_folder(spark, "agg-view")
    build_view(t.lineitem.filter(flag.isin("N", "A")), _VIEW_KEYS, _view_sums()).write.parquet(
        path
    )
    return apply_delta(
        spark.read.parquet(path),
        _VIEW_KEYS,
        _view_sums(),
        inserted=t.lineitem.filter(flag == "R"),
        deleted=loaded.filter((flag == "A") | (part == 776)),
    )
