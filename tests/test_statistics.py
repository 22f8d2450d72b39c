"""Running totals, step histograms, prefix densities and sketches."""

import random

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from quern.operators.aggregates import prefix_density
from quern.operators.histograms import step_histogram
from quern.operators.prefix_sums import first_above, prefix_sums, running_total
from quern.operators.sketches import (
    DISTINCT_ERROR, RANK_ERROR, SketchStore, merge_sketches, sketch_columns, sketch_report,
)


def test_prefix_sums_over_many_ranges(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 1, 5, -3, 10**12])) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v bigint").repartition(7)
    found = prefix_sums(df, ["k"], {"upto": F.col("v"), "n": F.lit(1)}, totals=True)
    total, expected = 0, {}
    for k, v in sorted(rows):
        total += v or 0
        expected[k] = (total, k + 1)
    got = found.collect()
    assert {r.k: (r.upto, r.n) for r in got} == expected
    assert {(r.total_upto, r.total_n) for r in got} == {(total, 500)}
    assert prefix_sums(df.limit(0), ["k"], {"upto": F.col("v")}).count() == 0


def test_running_total_of_a_loop(spark):
    rows = [(3, 4), (1, 10), (2, 7), (2, 7), (4, None), (5, 1)]
    df = spark.createDataFrame(rows, "k int, v int")
    found = running_total(df, ["k"], F.col("v"), "total", "loop", unique=False)
    got = sorted((r.k, r.total, r["loop"]) for r in found.collect() if r.k > 2)
    assert got == [(3, 28, 28), (4, 28, None), (5, 29, None)]
    pair = sorted((r.total, r["loop"]) for r in found.filter("k = 2").collect())
    assert pair == [(17, 17), (24, 24)]
    stop = first_above(found, ["k", "loop"], "loop", F.lit(16)).collect()
    assert [(r.k, r["loop"]) for r in stop] == [(2, 17)]
    assert first_above(found, ["k"], "loop", F.lit(28)).isEmpty()


def test_running_total_has_no_window_over_the_table(spark, tables):
    lines = tables.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    df = running_total(lines, ["l_orderkey", "l_linenumber"], F.col("l_quantity"), "total")
    text = plan_text(df)
    windows = [part for part in text.split("Window [")[1:]]
    # One window per range, and one over a row per range.
    assert "hashpartitioning(__part" in text
    assert all("__part" in w.split("\n")[0] for w in windows)


def steps(df, column, n):
    rows = sorted(step_histogram(df, column, n).collect())
    return [tuple(r)[1:5] for r in rows]


def test_steps_of_a_frequent_value(spark):
    values = [v for v in range(100)] + [50] * 300 + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    found = steps(df, "v", 10)
    assert found[0] == (None, 5, 0, 0)
    by_key = {r[0]: r for r in found}
    assert by_key[50] == (50, 301, 0, 0) or by_key[50][1] == 301
    assert found[-1][0] == 99
    assert sum(r[1] + r[2] for r in found) == len(values)
    assert sum(1 + r[3] for r in found[1:]) == 100
    # No step but the frequent value's has more rows than two even parts.
    assert all(r[1] + r[2] <= 2 * 40 for r in found if r[0] != 50)
    assert len(found) <= 21
    own = [r for r in found if r[0] == 50][0]
    assert own[2] == 0


@pytest.mark.parametrize("values, expected", [
    ([], []),
    ([None, None], [(None, 2, 0, 0)]),
    ([7] * 9, [(7, 9, 0, 0)]),
    ([1, 2, 3, 4], [(2, 1, 1, 1), (4, 1, 1, 1)]),
])
def test_steps_of_small_columns(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert steps(df, "v", 2) == expected


def test_steps_have_no_window_over_the_values(tables):
    text = plan_text(step_histogram(tables.lineitem, "l_partkey", 50))
    for window in text.split("Window [")[1:]:
        assert "range_hi_key" in window.split("\n")[0]


def test_four_prefixes_shuffle_the_keys_once(tables):
    columns = ["l_returnflag", "l_linenumber", "l_quantity", "l_suppkey"]
    df = prefix_density(tables.lineitem, columns)
    text = plan_text(df)
    assert text.count("Exchange hashpartitioning(") == 1
    assert text.count("Exchange SinglePartition") == 1  # one row of counts per task
    assert text.count("FileScan") == 1
    exact = [tables.lineitem.select(*columns[:n]).distinct().count() for n in range(1, 5)]
    assert [r.distinct_values for r in df.collect()] == exact


def test_densities_with_nulls_and_without_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, None), (None, None)], "a int, b int")
    assert [r.distinct_values for r in prefix_density(df, ["a", "b"]).collect()] == [2, 3]
    found = prefix_density(df.limit(0), ["a", "b"]).collect()
    assert [(r.distinct_values, r.density) for r in found] == [(0, None), (0, None)]


def test_united_sketches_equal_one_pass(spark, tables):
    lines = tables.lineitem.select("l_partkey", "l_extendedprice", "l_returnflag")
    parts = [lines.filter(F.pmod("l_partkey", F.lit(3)) == i) for i in range(3)]
    states = sketch_columns(parts[0], lines.columns)
    for part in parts[1:]:
        states = states.unionByName(sketch_columns(part, lines.columns))
    united = {r.column_name: r for r in sketch_report(merge_sketches(states)).collect()}
    whole = {r.column_name: r for r in sketch_report(merge_sketches(sketch_columns(lines, lines.columns))).collect()}
    for name in lines.columns:
        exact = lines.select(name).distinct().count()
        assert (united[name].n_rows, united[name].n_nulls) == (whole[name].n_rows, whole[name].n_nulls)
        for found in (united[name], whole[name]):
            assert abs(found.distinct_estimate - exact) <= 4 * DISTINCT_ERROR * exact + 1
    assert united["l_returnflag"].quantiles == [None] * 3
    n = lines.count()
    for rank, mark in zip((0.25, 0.5, 0.75), united["l_extendedprice"].quantiles):
        below = lines.filter(F.col("l_extendedprice") < mark).count() / n
        upto = lines.filter(F.col("l_extendedprice") <= mark).count() / n
        assert below - RANK_ERROR <= rank <= upto + RANK_ERROR


def test_a_batch_is_added_without_reading_the_others(spark, tmp_path):
    store = SketchStore(spark, str(tmp_path / "states"), ["v"])
    store.add(spark.range(100).select(F.col("id").alias("v")), 0)
    store.add(spark.range(100, 300).select(F.col("id").alias("v")), 1)
    store.add(spark.range(100, 300).select(F.col("id").alias("v")), 1)  # the batch runs again
    store.add(spark.createDataFrame([(None,)], "v bigint"), 2)
    (row,) = store.report().collect()
    assert (row.n_rows, row.n_nulls) == (301, 1)
    assert abs(row.distinct_estimate - 300) <= 4 * DISTINCT_ERROR * 300
    text = plan_text(store.merged())
    assert text.count("FileScan") == 1 and "states" in text
