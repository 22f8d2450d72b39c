"""Reports as SQL table functions, usable per row through LATERAL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quern.sources.tables import Tables


def register_table_functions(spark: SparkSession, t: Tables) -> None:
    """Create ``orders_of(customer)`` and ``lines_of(order)`` for this session.

    A lateral call per row is turned into an equality join by the optimizer.
    """
    t.register("orders", "lineitem", prefix="quern_")
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION orders_of(customer BIGINT)
        RETURNS TABLE (order_id BIGINT, placed TIMESTAMP_NTZ, amount DOUBLE)
        RETURN SELECT o_orderkey, o_orderdate, o_totalprice
               FROM quern_orders WHERE o_custkey = orders_of.customer
        """
    )
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION lines_of(order_id BIGINT)
        RETURNS TABLE (line_part BIGINT, quantity DOUBLE, price DOUBLE)
        RETURN SELECT l_partkey, l_quantity, l_extendedprice
               FROM quern_lineitem WHERE l_orderkey = lines_of.order_id
        """
    )
