"""The physical plans that the operators promise."""

from datetime import datetime

import pytest
from conftest import DATA, plan_text
from pyspark.sql import functions as F

import __spark_entry__ as contract
from quern.functions.dates import in_month, us_date
from quern.operators.filters import equals_literal, text_prefix
from quern.operators.joins import join_by
from quern.operators.maintained import apply_delta, build_view
from quern.operators.ranking import top_with_position
from quern.plans import reports

QUERIES = contract.queries()


def scans(df) -> list[str]:
    return [line for line in plan_text(df).splitlines() if "FileScan" in line]


def pushed(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return "\n".join(line for line in text.splitlines() if "PushedFilters" in line)


def test_bare_column_filters_are_pushed(tables):
    orders = tables.orders
    assert "EqualTo(o_orderkey,1700)" in pushed(orders.filter(F.col("o_orderkey") == 3400 // 2))
    assert "EqualTo(o_custkey,42)" in pushed(equals_literal(orders, "o_custkey", "42"))
    month = pushed(orders.filter(in_month(F.col("o_orderdate"), 1998, 4)))
    assert "GreaterThanOrEqual(o_orderdate" in month and "LessThan(o_orderdate" in month
    day = pushed(orders.filter(F.col("o_orderdate") >= us_date("4/1/1998")))
    assert "GreaterThanOrEqual(o_orderdate" in day
    name = pushed(tables.part.filter(text_prefix(F.col("p_name"), "blue")))
    assert "StringStartsWith(p_name,blue)" in name
    keys = pushed(tables.lineitem.filter(F.col("l_orderkey").isin(*range(42, 54))))
    assert "In(l_orderkey" in keys


def test_computed_filters_are_not_pushed(tables):
    plan = pushed(tables.orders.filter(F.year("o_orderdate") == 1998))
    assert "EqualTo" not in plan and "GreaterThan" not in plan


def test_narrow_scan_reads_three_columns(spark):
    (scan,) = scans(QUERIES["scan_narrow"](spark, DATA))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in scan


def test_extremes_come_from_footers(spark):
    df = QUERIES["scalar_min_footer"](spark, DATA)
    assert "PushedAggregation: [MIN(l_extendedprice), MAX(l_extendedprice), COUNT(*)]" in (
        plan_text(df)
    )
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_contradiction_needs_no_scan(tables):
    size = F.col("p_size")
    df = tables.part.filter((size == 20) & (size == 30))
    assert scans(df) == []


def test_rollup_aggregates_before_the_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan_text(QUERIES["product_qty"](spark, DATA))
    join = text.index("SortMergeJoin")
    assert "partial_sum" in text[join:]
    # The per-key aggregate and the join share one partitioning of the lines.
    assert text.count("Exchange hashpartitioning(l_partkey") == 1


def test_view_delta_shuffles_once(tables):
    sums = {"q": F.col("l_quantity")}
    view = build_view(tables.lineitem, ["l_partkey"], sums)
    stored = tables.spark.createDataFrame([], view.schema)
    text = plan_text(
        apply_delta(stored, ["l_partkey"], sums, tables.lineitem, tables.lineitem)
    )
    assert text.count("Exchange") == 1


def test_position_in_other_order_sorts_nothing_big(tables):
    df = top_with_position(
        tables.part, [("p_retailprice", True), ("p_partkey", False)], 10,
        [("p_name", True), ("p_partkey", False)],
    )
    text = plan_text(df)
    assert "rangepartitioning" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # The one single-partition window sees the aggregated slots only.
    window = text[text.index("Window"):]
    assert window.index("HashAggregate") < window.index("FileScan")


@pytest.mark.parametrize(
    "method, operator",
    [("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"),
     ("shuffle_hash", "ShuffledHashJoin")],
)
def test_join_hints(tables, method, operator):
    on = F.col("o_custkey") == F.col("c_custkey")
    assert operator in plan_text(join_by(tables.orders, tables.customer, on, method))


def test_broadcast_needs_a_small_side(tables):
    on = F.col("o_custkey") == F.col("c_custkey")
    df = join_by(tables.orders, tables.customer, on, "broadcast", broadcast_rows=10)
    assert "SortMergeJoin" in plan_text(df)
    with pytest.raises(ValueError, match="unknown join method"):
        join_by(tables.orders, tables.customer, on, "loop")


def test_skewed_join_is_split(spark, tables, tmp_path, conf):
    # A partition is split between map tasks, so the tables need several files.
    for name in ("orders", "events"):
        getattr(tables, name).repartition(8).write.parquet(str(tmp_path / f"{name}.parquet"))
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB",
        spark__sql__shuffle__partitions="16",
    )
    df = QUERIES["join_skew"](spark, str(tmp_path))
    assert df.count() == QUERIES["join_skew"](spark, DATA).count()
    df.collect()
    assert "skew=true" in plan_text(df)


def test_latest_joins_on_both_columns(tables, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan_text(reports.latest_transactions(tables, datetime(1998, 1, 1)))
    assert "hashpartitioning(l_partkey#" in text and ", l_orderkey#" in text
    assert "Window" not in text


def test_event_document_is_parsed_once(spark):
    text = plan_text(QUERIES["xe_shred"](spark, DATA))
    assert text.count("from_xml") == 1


def test_temporary_frame_is_shuffled_once(spark):
    df = QUERIES["temp_reuse"](spark, DATA)
    df.collect()
    final = plan_text(df)
    assert "ReusedExchange" in final or "ReusedSubquery" in final


NO_PAIRS = sorted(set(QUERIES) - {"layout_report"})


@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_query_compares_all_pairs(spark, name, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan_text(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text  # no Python worker in any plan
