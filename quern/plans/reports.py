"""Parameterised reports: Python functions that build one plan per argument set.

All parameters are typed values.  None is pasted into query text.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.numeric import cents, cents_to_amount
from quern.operators.aggregates import rollup_then_lookup
from quern.operators.filters import optional_equals
from quern.operators.joins import latest_per_key
from quern.operators.prefix_sums import first_above, running_total
from quern.operators.ranking import number_within
from quern.sources.tables import Tables

# The limit and the two texts of the loss verdict.
LOSS_LIMIT = 5000
LOSS_ABOVE = "We are bankrupt!"
LOSS_BELOW = "We are safe!"


def _lines_of_orders(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))


def customer_product_lines(t: Tables, customer: int, part_below: int) -> DataFrame:
    """Order lines of one customer for a range of parts."""
    return (
        _lines_of_orders(t)
        .filter((F.col("o_custkey") == customer) & (F.col("l_partkey") < part_below))
        .select("o_orderkey", "o_orderdate", "l_partkey", "l_quantity", "l_extendedprice")
    )


def customer_product_lines_sql(t: Tables, customer: int, part_below: int) -> DataFrame:
    """The same report as SQL text with typed arguments."""
    return t.spark.sql(
        """
        SELECT o_orderkey, o_orderdate, l_partkey, l_quantity, l_extendedprice
        FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey
        WHERE o_custkey = :customer AND l_partkey < :part_below
        """,
        args={"customer": customer, "part_below": part_below},
        orders=t.orders,
        lineitem=t.lineitem,
    )


def customers_from(t: Tables, customer: int) -> DataFrame:
    """Order lines of the customers from a key upward."""
    return (
        _lines_of_orders(t)
        .filter(F.col("o_custkey") >= customer)
        .select("o_custkey", "o_orderkey", "o_orderdate", "l_quantity", "l_extendedprice")
    )


def address_by_city(
    customers: DataFrame, nations: DataFrame, regions: DataFrame, city: str
) -> DataFrame:
    """Customers of one city (here: market segment) with state and country.

    The lookups may come from any reader.  Their size is measured by adaptive
    execution, which broadcasts them when they are small.
    """
    return (
        customers.filter(F.col("c_mktsegment") == city)
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "c_custkey",
            "c_name",
            F.col("c_mktsegment").alias("city"),
            F.col("n_name").alias("state_name"),
            F.col("r_name").alias("country_name"),
        )
    )


def product_as_of(t: Tables, part: int, as_of: datetime | None = None) -> DataFrame:
    """Lines of one part dated before an instant, by default now."""
    moment = F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    return (
        t.part.filter(F.col("p_partkey") == part)
        .join(t.lineitem, F.col("p_partkey") == F.col("l_partkey"))
        .filter(F.col("l_shipdate") < moment)
        .select("p_partkey", "p_name", "p_brand", "l_orderkey", "l_quantity", "l_shipdate")
    )


def purchase_from(t: Tables, first: int, last: int | None = None) -> DataFrame:
    """Line amounts and dates from an order key on, or within a key range."""
    key = F.col("o_orderkey")
    wanted = key >= first if last is None else key.between(first, last)
    return (
        _lines_of_orders(t)
        .filter(wanted)
        .select("o_orderkey", "l_extendedprice", "o_orderdate")
    )


def cart_lines(t: Tables, cart: int) -> DataFrame:
    """Quantity, price, product of both and name for the lines of one cart."""
    return (
        t.lineitem.filter(F.col("l_orderkey") == cart)
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_quantity",
            "p_retailprice",
            F.round(F.col("p_retailprice") * F.col("l_quantity"), 2).alias("line_total"),
            "p_name",
        )
    )


def order_lines(t: Tables, order: int | None = None) -> DataFrame:
    """Lines of an order, numbered by ship date and shown by product name.

    Without an order key the lines of all orders are numbered, each order by
    itself, and come in no particular order: that spares a sort of the table.
    """
    items = optional_equals(t.lineitem, "l_orderkey", order)
    lines = (
        items.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "l_shipdate", "l_extendedprice", "l_partkey", "p_name")
    )
    # The ship date is not unique; the other output columns settle ties.
    terms = [
        (c, False) for c in ("l_shipdate", "l_extendedprice", "l_partkey", "p_name")
    ]
    numbered = number_within(
        lines, ["l_orderkey"], terms, "line_number", sized_by=items
    )
    shown = numbered.select("l_orderkey", "line_number", "p_name", "l_extendedprice")
    return shown if order is None else shown.orderBy("p_name", "line_number")


def latest_transactions(
    t: Tables, since: datetime, name: str | None = None
) -> DataFrame:
    """Latest lines (highest order key) per part, if dated after ``since``.

    The name pattern picks parts.  The date applies to the latest lines only: a
    part whose latest line is older gives no row.
    """
    parts = t.part.select("p_partkey", "p_name")
    if name is not None:
        parts = parts.filter(F.col("p_name").like(name))
    lines = t.lineitem.select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity",
        "l_shipdate",
    )
    latest = latest_per_key(lines, "l_partkey", "l_orderkey", parts, "p_partkey")
    return latest.filter(
        F.col("l_shipdate") > F.lit(since).cast("timestamp_ntz")
    ).select(
        "p_partkey", "p_name", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"
    )


def purchase_by_person(
    t: Tables, name: str, supplier: int | None = None
) -> DataFrame:
    """Purchase lines by buyer name, for one supplier or for all."""
    people = t.customer.filter(F.col("c_name").like(name)).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    # The few buyers thin out the orders before these meet the lines.
    bought = t.orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    return (
        optional_equals(t.lineitem, "l_suppkey", supplier)
        .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "o_orderkey",
            "o_orderdate",
            "l_extendedprice",
            "p_name",
            "c_mktsegment",
            F.concat("c_name", F.lit(", "), "n_name").alias("person"),
            "l_suppkey",
        )
        .orderBy("person", "o_orderkey", "l_extendedprice")
    )


def store_contact(t: Tables) -> DataFrame:
    """Supplier with the text 'region, nation' of its location."""
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_name").alias("store_name"),
            F.concat("r_name", F.lit(", "), "n_name").alias("contact"),
        )
    )


def total_loss(t: Tables, lost: Column) -> DataFrame:
    """Value of the lost lines at list price, and the verdict on the sum.

    The inner sum per part is exact in cents; without any lost line the total is
    NULL and the verdict is the lower one.
    """
    quantities = t.lineitem.filter(lost)
    per_name = rollup_then_lookup(
        quantities,
        "l_partkey",
        {"quantity": F.sum(F.col("l_quantity").cast("bigint"))},
        t.part.select("p_partkey", cents(F.col("p_retailprice")).alias("price")),
        "p_partkey",
        ["p_partkey", "price"],
    )
    loss = F.sum(F.col("quantity").cast("decimal(18,0)") * F.col("price"))
    return per_name.agg(
        cents_to_amount(loss).alias("total_loss"),
    ).select(
        "total_loss",
        F.when(F.col("total_loss") > LOSS_LIMIT, LOSS_ABOVE)
        .otherwise(LOSS_BELOW)
        .alias("status"),
    )


#: A total order of the lines of :func:`running_loss`; lines equal in it are copies.
LOSS_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "loss_cents")


def running_loss(t: Tables, lost: Column) -> DataFrame:
    """Lost lines in order, each with the loss so far.

    ``running_total`` leaves out lines without a known loss.  ``loop_total`` is what a
    loop has that adds each loss to a variable: after an unknown one it stays NULL.
    """
    prices = t.part.select("p_partkey", cents(F.col("p_retailprice")).alias("price"))
    losses = (
        t.lineitem.filter(lost)
        .join(prices, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            (F.col("l_quantity").cast("bigint") * F.col("price")).alias("loss_cents"),
        )
    )
    order = [F.col(c).asc_nulls_first() for c in LOSS_ORDER]
    return running_total(
        losses, order, F.col("loss_cents"), "running_cents", "loop_cents", unique=False
    )


def loss_stop(t: Tables, lost: Column) -> DataFrame:
    """The line at which the loop's total first passes the limit."""
    order = [F.col(c).asc_nulls_first() for c in LOSS_ORDER]
    limit = F.lit(LOSS_LIMIT * 100)
    return first_above(running_loss(t, lost), [*order, "loop_cents"], "loop_cents", limit)
