"""Forms that must agree, and forms that must differ."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quern.functions.dates import in_month, us_date
from quern.functions.numeric import (
    average_amount,
    money,
    rounded_int,
    sum_amount,
    whole_average,
    whole_quotient,
)
from quern.functions.text import drop_last_char, join_text, visible_length
from quern.operators.filters import (
    has_rows,
    optional_equals,
    outside_range,
    text_contains,
    text_prefix,
    text_suffix,
)
from quern.plans import reports
from quern.sources.literals import literal_rows


def same(left, right):
    assert rows(left) == rows(right)
    assert left.count() > 0


def test_or_list_range(tables):
    lines, key = tables.lineitem, F.col("l_orderkey")
    chain = key == 42
    for k in range(43, 54):
        chain = chain | (key == k)
    same(lines.filter(chain), lines.filter(key.isin(*range(42, 54))))
    same(lines.filter(chain), lines.filter(key.between(42, 53)))


def test_prefix_as_range(tables):
    parts, name = tables.part, F.col("p_name")
    same(parts.filter(text_prefix(name, "blu")), parts.filter((name >= "blu") & (name < "blv")))


def test_between_as_two_comparisons(tables):
    key = F.col("o_orderkey")
    same(
        tables.orders.filter(key.between(40, 60)),
        tables.orders.filter((key >= 40) & (key <= 60)),
    )


def test_computed_and_bare_column(tables):
    orders, key = tables.orders, F.col("o_orderkey")
    same(orders.filter(key * 2 == 340), orders.filter(key == 340 // 2))
    parts, name = tables.part, F.col("p_name")
    same(parts.filter(F.substring(name, 1, 1) == "b"), parts.filter(name.startswith("b")))


def test_month_forms(tables):
    day = F.col("o_orderdate")
    for year, month in ((1998, 4), (1996, 12)):
        same(
            tables.orders.filter((F.year(day) == year) & (F.month(day) == month)),
            tables.orders.filter(in_month(day, year, month)),
        )


def test_exists_and_count(tables):
    for quantity, expected in ((1, True), (51, False)):
        found = tables.lineitem.filter(F.col("l_quantity") == quantity)
        assert has_rows(found) is expected is (found.count() > 0)


def test_loop_and_set_form_of_the_loss(spark, tables):
    lost = F.col("l_returnflag") == "R"
    verdict = reports.total_loss(tables, lost).first()
    joined = tables.lineitem.filter(lost).join(
        tables.part, F.col("l_partkey") == F.col("p_partkey")
    )
    total = 0.0
    for row in joined.select("l_quantity", "p_retailprice").collect():
        total += row.l_quantity * row.p_retailprice
    assert float(verdict.total_loss) == pytest.approx(total)
    assert verdict.status == reports.LOSS_ABOVE
    none = reports.total_loss(tables, F.col("l_returnflag") == "?").first()
    assert tuple(none) == (None, reports.LOSS_BELOW)


def test_optional_argument_forms(tables):
    pattern = "Customer#00000000%"
    everything = reports.purchase_by_person(tables, pattern)
    one = reports.purchase_by_person(tables, pattern, 7)
    same(one, everything.filter(F.col("l_suppkey") == 7))
    coalesced = everything.filter(
        F.col("l_suppkey") == F.coalesce(F.lit(None).cast("bigint"), F.col("l_suppkey"))
    )
    same(coalesced, everything)


def test_optional_argument_keeps_null_rows(spark):
    table = literal_rows(spark, "k int", [(1,), (None,)])
    assert optional_equals(table, "k", None).count() == 2
    assert optional_equals(table, "k", 1).count() == 1


def test_report_and_its_sql_text(tables):
    same(
        reports.customer_product_lines(tables, 42, 150),
        reports.customer_product_lines_sql(tables, 42, 150),
    )


def test_range_with_and_without_null(spark):
    table = literal_rows(spark, "x string", [("A",), ("M",), ("Z",), (None,)])
    x = F.col("x")
    assert table.filter(outside_range(x, "B", "P")).count() == 2
    assert table.filter(outside_range(x, "B", "P", keep_null=True)).count() == 3


def test_union_forms_differ(tables):
    pairs = tables.lineitem.filter(F.col("l_partkey").isin(7, 8)).select("l_linenumber")
    assert pairs.union(pairs).count() > pairs.union(pairs).distinct().count()


def test_null_concatenation(spark):
    row = spark.range(1).select(
        join_text(F.lit("a"), F.lit(None), F.lit("b")).alias("n"),
        join_text(F.lit("a"), F.lit(None), F.lit("b"), null_wins=False).alias("e"),
    ).first()
    assert (row.n, row.e) == (None, "ab")


def test_letter_case(spark):
    names = literal_rows(spark, "s string", [("Ice cap",), ("ice Cap",)])
    s = F.col("s")
    for exact, loose in (
        (text_prefix(s, "Ice"), text_prefix(s, "ICE", ignore_case=True)),
        (text_suffix(s, "cap"), text_suffix(s, "CAP", ignore_case=True)),
        (text_contains(s, "e c"), text_contains(s, "E C", ignore_case=True)),
    ):
        assert names.filter(exact).count() == 1
        assert names.filter(loose).count() == 2


def test_text_length_and_cut(spark):
    row = literal_rows(spark, "s string", [("ab ",)]).select(
        visible_length(F.col("s")).alias("n"), drop_last_char(F.col("s")).alias("cut")
    ).first()
    assert (row.n, row.cut) == (2, "a")


def test_dates_and_numbers(spark):
    row = spark.range(1).select(
        us_date("4/1/2005").alias("d"),
        whole_quotient(F.lit(7), F.lit(2)).alias("q"),
        rounded_int(money(F.lit(15.9))).alias("r"),
        (F.lit(7) / F.lit(2)).alias("x"),
    ).first()
    assert row.d == datetime(2005, 4, 1)
    assert (row.q, row.r, row.x) == (3, 16, 3.5)


def test_exact_sums(spark):
    amounts = literal_rows(spark, "v double, n bigint", [(0.1, 1), (0.2, 2), (0.3, 2)])
    row = amounts.agg(
        sum_amount(F.col("v")).alias("total"),
        average_amount(F.col("v")).alias("mean"),
        whole_average(F.col("n")).alias("whole"),
    ).first()
    assert str(row.total) == "0.60" and row.mean == 0.2 and row.whole == 1


def test_division_by_zero_raises(spark):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        spark.range(1).select(F.lit(1) / (F.col("id") * 0)).collect()
