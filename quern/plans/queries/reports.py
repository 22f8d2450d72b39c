"""The parameterised reports, with arguments that return rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.numeric import cents_to_amount
from quern.plans import reports as report
from quern.plans.registry import query
from quern.session import shared_folder
from quern.sources.tables import Tables

_CUSTOMER_SQL = """
    SELECT o_orderkey, o_orderdate, l_partkey, l_quantity, l_extendedprice
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_custkey = 42 AND l_partkey < 500
"""


@query(_CUSTOMER_SQL)
def customer_product_lines(spark: SparkSession, t: Tables) -> DataFrame:
    return report.customer_product_lines(t, 42, 500)


@query(_CUSTOMER_SQL)
def customer_product_lines_sql(spark: SparkSession, t: Tables) -> DataFrame:
    return report.customer_product_lines_sql(t, 42, 500)


@query(
    """
    SELECT o_custkey, o_orderkey, o_orderdate, l_quantity, l_extendedprice
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey >= 1400
    """
)
def customers_from(spark: SparkSession, t: Tables) -> DataFrame:
    return report.customers_from(t, 1400)


@query(
    """
    SELECT c_custkey, c_name, c_mktsegment AS city, n_name AS state_name,
           r_name AS country_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment = 'BUILDING'
    """
)
def address_by_city(spark: SparkSession, t: Tables) -> DataFrame:
    # The lookups were copied from other stores, in other formats.
    nations, regions = (shared_folder(spark, n) for n in ("nation", "region"))
    t.nation.write.orc(nations)
    t.region.write.json(regions)
    return report.address_by_city(
        t.customer,
        spark.read.schema(t.nation.schema).orc(nations),
        spark.read.schema(t.region.schema).json(regions),
        "BUILDING",
    )


@query(
    """
    SELECT p_partkey, p_name, p_brand, l_orderkey, l_quantity, l_shipdate
    FROM part JOIN lineitem ON p_partkey = l_partkey
    WHERE p_partkey = 776 AND l_shipdate < TIMESTAMP '1998-06-01'
    """
)
def product_as_of(spark: SparkSession, t: Tables) -> DataFrame:
    return report.product_as_of(t, 776, datetime(1998, 6, 1))


@query(
    """
    SELECT o_orderkey, l_extendedprice, o_orderdate
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderkey >= 1000
    """
)
def purchase_from(spark: SparkSession, t: Tables) -> DataFrame:
    return report.purchase_from(t, 1000)


@query(
    """
    SELECT o_orderkey, l_extendedprice, o_orderdate
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderkey BETWEEN 1 AND 42
    """
)
def purchase_between(spark: SparkSession, t: Tables) -> DataFrame:
    return report.purchase_from(t, 1, 42)


@query(
    """
    SELECT l_quantity, p_retailprice, round(p_retailprice * l_quantity, 2) AS line_total,
           p_name
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey = 42
    """
)
def cart_lines(spark: SparkSession, t: Tables) -> DataFrame:
    return report.cart_lines(t, 42)


_LINES_SQL = """
    SELECT l_orderkey,
           row_number() OVER (PARTITION BY l_orderkey
               ORDER BY l_shipdate NULLS FIRST, l_extendedprice NULLS FIRST,
               l_partkey NULLS FIRST, p_name NULLS FIRST) AS line_number,
           p_name, l_extendedprice
    FROM lineitem JOIN part ON l_partkey = p_partkey {where}
"""


@query(_LINES_SQL.format(where=""))
def order_lines(spark: SparkSession, t: Tables) -> DataFrame:
    return report.order_lines(t)


@query(_LINES_SQL.format(where="WHERE l_orderkey = 42"))
def order_lines_one(spark: SparkSession, t: Tables) -> DataFrame:
    return report.order_lines(t, 42)


_LATEST_SQL = """
    SELECT p_partkey, p_name, l_orderkey, l_linenumber, l_returnflag, l_quantity
    FROM part JOIN lineitem ON p_partkey = l_partkey
         AND l_orderkey = (SELECT max(x.l_orderkey) FROM lineitem x
                           WHERE x.l_partkey = p_partkey)
    WHERE l_shipdate > TIMESTAMP '{since}' {name}
"""


@query(_LATEST_SQL.format(since="1998-01-01", name="AND p_name LIKE 'blue%'"))
def latest_per_key(spark: SparkSession, t: Tables) -> DataFrame:
    return report.latest_transactions(t, datetime(1998, 1, 1), "blue%")


@query(_LATEST_SQL.format(since="1900-01-01", name=""))
def latest_per_key_all(spark: SparkSession, t: Tables) -> DataFrame:
    return report.latest_transactions(t, datetime(1900, 1, 1))


_PERSON_SQL = """
    SELECT o_orderkey, o_orderdate, l_extendedprice, p_name, c_mktsegment,
           c_name || ', ' || n_name AS person, l_suppkey
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    WHERE c_name LIKE '{name}' {supplier}
"""


@query(_PERSON_SQL.format(name="Customer#0000000%", supplier=""))
def purchase_by_person(spark: SparkSession, t: Tables) -> DataFrame:
    return report.purchase_by_person(t, "Customer#0000000%")


@query(_PERSON_SQL.format(name="Customer#0000000%", supplier="AND l_suppkey = 7"))
def purchase_by_person_vendor(spark: SparkSession, t: Tables) -> DataFrame:
    return report.purchase_by_person(t, "Customer#0000000%", 7)


@query(
    """
    SELECT s_name AS store_name, r_name || ', ' || n_name AS contact
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    """
)
def store_contact(spark: SparkSession, t: Tables) -> DataFrame:
    return report.store_contact(t)


@query(
    """
    SELECT total_loss, CASE WHEN total_loss > 5000 THEN 'We are bankrupt!'
                            ELSE 'We are safe!' END AS status
    FROM (SELECT CAST(sum(CAST(l_quantity AS DECIMAL(18,0)) * CAST(p_retailprice AS DECIMAL(18,2)))
                 AS DECIMAL(28,2)) AS total_loss
          FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R')
    """
)
def total_loss(spark: SparkSession, t: Tables) -> DataFrame:
    return report.total_loss(t, F.col("l_returnflag") == "R")


_RUNNING_SQL = """
    SELECT *, CAST(sum(loss_cents) OVER w AS BIGINT) AS known,
           count(*) FILTER (loss_cents IS NULL) OVER w AS unknown
    FROM (SELECT l_orderkey, l_linenumber, l_partkey,
                 CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT)
                     AS loss_cents
          FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R')
    WINDOW w AS (ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST,
                 l_partkey NULLS FIRST, loss_cents NULLS FIRST ROWS UNBOUNDED PRECEDING)
"""


def _amounts(df: DataFrame) -> DataFrame:
    names = {"loss": "loss_cents", "running_total": "running_cents", "loop_total": "loop_cents"}
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        *[cents_to_amount(F.col(c)).alias(n) for n, c in names.items()],
    )


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(loss_cents / 100.0 AS DECIMAL(28,2)) AS loss,
           CAST(coalesce(known, 0) / 100.0 AS DECIMAL(28,2)) AS running_total,
           CASE WHEN unknown = 0 THEN CAST(known / 100.0 AS DECIMAL(28,2)) END AS loop_total
    FROM ({_RUNNING_SQL})
    """
)
def running_loss(spark: SparkSession, t: Tables) -> DataFrame:
    return _amounts(report.running_loss(t, F.col("l_returnflag") == "R"))


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(loss_cents / 100.0 AS DECIMAL(28,2)) AS loss,
           CAST(coalesce(known, 0) / 100.0 AS DECIMAL(28,2)) AS running_total,
           CAST(known / 100.0 AS DECIMAL(28,2)) AS loop_total
    FROM ({_RUNNING_SQL}) WHERE unknown = 0 AND known > 500000
    ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
             loss_cents NULLS FIRST, known LIMIT 1
    """
)
def loss_stop(spark: SparkSession, t: Tables) -> DataFrame:
    return _amounts(report.loss_stop(t, F.col("l_returnflag") == "R"))
