"""Table changes and checked loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.numeric import MONEY, cents, money, rounded_int
from quern.functions.text import drop_last_char
from quern.operators import changes as change
from quern.operators.loads import (
    checked_load as load_checked,
    key_report,
    missing_values,
    orphans,
    repeated_keys,
)
from quern.plans.registry import query
from quern.session import shared_folder
from quern.sources.sinks import create_table_as
from quern.sources.tables import Tables
from quern.sources.versions import VersionedTable


@query(
    """
    SELECT p_partkey, p_name,
           CASE WHEN p_partkey BETWEEN 40 AND 1700 THEN 99 ELSE p_size END AS p_size
    FROM part
    """
)
def upd_range(spark: SparkSession, t: Tables) -> DataFrame:
    """Copy the table, change a key range of the copy, write the next version."""
    path = shared_folder(spark, "part-v1")
    copy = create_table_as(
        t.part.select("p_partkey", "p_name", "p_size"), "quern_part_v1", path, replace=True
    )
    changed = change.update_where(
        copy, {"p_size": 99}, F.col("p_partkey").between(40, 1700)
    )
    target = shared_folder(spark, "part-v2")
    return create_table_as(changed, "quern_part_v2", target, replace=True)


def _priced(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", money(F.col("p_retailprice")).alias("price"))


@query(
    """
    SELECT p_partkey,
           CAST(CASE WHEN price > 950 THEN price * 0.6 ELSE price - 10 END AS DECIMAL(19,4))
               AS price
    FROM (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(19,4)) AS price FROM part)
    """
)
def upd_discount(spark: SparkSession, t: Tables) -> DataFrame:
    price = F.col("price")
    factor = F.lit("0.6").cast("decimal(2,1)")
    return change.update_where(
        _priced(t), {"price": F.when(price > 950, price * factor).otherwise(price - 10)}
    )


@query(
    """
    SELECT c_custkey, c_nationkey,
           CAST(CAST(c_acctbal AS DECIMAL(19,4)) + CASE WHEN c_nationkey = 10 THEN
               (SELECT CAST(100.0::DOUBLE / count(*) AS DECIMAL(19,4)) FROM customer
                WHERE c_nationkey = 10)
           ELSE 0 END AS DECIMAL(19,4)) AS salary
    FROM customer
    """
)
def pay_bonus(spark: SparkSession, t: Tables) -> DataFrame:
    return _bonus(t)[0]


@query(
    """
    SELECT members, bonus, CAST(100 - members * bonus AS DECIMAL(19,4)) AS balance
    FROM (SELECT count(*) AS members, CAST(100.0::DOUBLE / count(*) AS DECIMAL(19,4)) AS bonus
          FROM customer WHERE c_nationkey = 10)
    """
)
def pay_bonus_balance(spark: SparkSession, t: Tables) -> DataFrame:
    return _bonus(t)[1]


def _bonus(t: Tables) -> tuple[DataFrame, DataFrame]:
    staff = t.customer.select(
        "c_custkey", "c_nationkey", F.col("c_acctbal").cast(MONEY).alias("salary")
    )
    return change.split_fund(staff, "salary", "100", F.col("c_nationkey") == 10)


@query(
    """
    SELECT p_partkey,
           CAST(CASE WHEN p_partkey IN (1, 150) AND round(price) > 910 THEN price - 10
                ELSE price END AS DECIMAL(19,4)) AS price
    FROM (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(19,4)) AS price FROM part)
    """
)
def upd_guarded(spark: SparkSession, t: Tables) -> DataFrame:
    """Two guarded changes; the guard reads the amount into a whole number."""
    price, rows = F.col("price"), _priced(t)
    for part in (1, 150):
        rows = change.guarded_update(
            rows, "price", price - 10, F.col("p_partkey") == part, rounded_int(price) > 910
        )
    return rows


@query(
    """
    SELECT c_custkey, c_name || 'z' AS c_name,
           left(c_name || 'z', length(c_name || 'z') - 1) AS trimmed
    FROM customer
    """
)
def upd_suffix(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name")
    longer = change.update_where(rows, {"c_name": F.concat("c_name", F.lit("z"))})
    return longer.withColumn("trimmed", drop_last_char(F.col("c_name")))


@query(
    """
    SELECT o_orderkey, status FROM
        (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)
    WHERE NOT coalesce(status = 'F', false)
    """
)
def del_range(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    return change.delete_where(rows, F.col("status") == "F")


@query(
    """
    SELECT s_suppkey, s_name, s_suppkey BETWEEN 5 AND 60 AS is_deleted FROM supplier
    """
)
def soft_delete(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", "s_name")
    return change.soft_delete(rows, F.col("s_suppkey").between(5, 60))


@query(
    """
    SELECT 'statement' AS mode, p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20
    """
)
def checked_load(spark: SparkSession, t: Tables) -> DataFrame:
    """All parts break the rule as one batch; those that satisfy it load.

    The mode that takes all batches or none adds no row.
    """
    rows = t.part.select("p_partkey", "p_size")
    size = F.col("p_size")
    batches = [rows, rows.filter(size.between(10, 20))]
    rules = {"size": size.between(10, 20)}
    empty = spark.createDataFrame([], rows.schema)
    parts = [
        load_checked(empty, batches, rules, mode).table.select(
            F.lit(mode).alias("mode"), "p_partkey", "p_size"
        )
        for mode in ("statement", "all")
    ]
    return parts[0].unionByName(parts[1])


@query(
    """
    SELECT 'repeated line key' AS check_name, count(*) AS violations FROM
        (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL
    SELECT 'repeated order key', count(*) FROM
        (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    UNION ALL
    SELECT 'missing status', count(*) FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL
    UNION ALL
    SELECT 'order without customer', count(*) FROM orders
    WHERE o_custkey IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
    UNION ALL
    SELECT 'order without line', count(*) FROM orders
    WHERE o_orderkey IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """
)
def key_checks(spark: SparkSession, t: Tables) -> DataFrame:
    statuses = t.orders.select(F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    report = key_report(
        {
            "repeated line key": repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"]),
            "repeated order key": repeated_keys(t.orders, ["o_orderkey"]),
            "order without customer": orphans(
                t.orders, "o_custkey", t.customer, "c_custkey"
            ),
            "order without line": orphans(
                t.orders, "o_orderkey", t.lineitem, "l_orderkey"
            ),
        }
    )
    missing = missing_values(statuses, ["status"]).select(
        F.lit("missing status").alias("check_name"), F.col("status").alias("violations")
    )
    return report.unionByName(missing)


@query(
    """
    SELECT p_partkey, p_name, rpad(CAST(p_size AS VARCHAR), 500, ' ') AS p_size FROM part
    """
)
def retype_column(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", "p_name", "p_size")
    return change.retype(rows, "p_size", "string", width=500)


@query(
    """
    SELECT 1 AS version, o_orderstatus, count(*) AS n_rows,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders GROUP BY o_orderstatus
    UNION ALL
    SELECT 2, o_orderstatus, count(*),
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)
               - CASE WHEN o_orderstatus = 'F' THEN 100 ELSE 0 END) AS BIGINT)
    FROM orders WHERE o_orderstatus IS DISTINCT FROM 'P' GROUP BY o_orderstatus
    """
)
def publish_versions(spark: SparkSession, t: Tables) -> DataFrame:
    """A table is replaced and compacted while a reader of its first version goes on."""
    status = F.col("o_orderstatus")
    table = VersionedTable(spark, shared_folder(spark, "orders-published"))
    first = t.orders.select("o_orderkey", cents(F.col("o_totalprice")).alias("cents"), "o_orderstatus")
    table.publish(first, "o_orderstatus")
    reader = table.read()
    cheaper = F.col("cents") - F.when(status == "F", 100).otherwise(0)
    table.publish(
        reader.filter(~status.eqNullSafe("P")).withColumn("cents", cheaper), "o_orderstatus"
    )
    table.compact()
    parts = [
        rows.groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("cents").alias("cents"))
        .select(F.lit(number).alias("version"), "o_orderstatus", "n_rows", "cents")
        for number, rows in ((1, reader), (2, table.read()))
    ]
    return parts[0].unionByName(parts[1])
