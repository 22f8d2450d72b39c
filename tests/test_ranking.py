"""Numbering against brute force, with NULLs, ties and hot groups."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from conftest import plan_text, rows
from pyspark.sql import functions as F

from quern.operators.ranking import (
    frequent_buckets,
    global_positions,
    number_copies,
    number_within,
    sort_columns,
    top_numbered,
    top_with_position,
)
from quern.sources.literals import literal_rows

LOW = (0,)


def key(terms, names):
    """Python sort with NULL as the lowest value."""

    def one(row):
        out = []
        for name, down in terms:
            value = row[names.index(name)]
            ranked = LOW if value is None else (1, value)
            out.append(_Down(ranked) if down else ranked)
        return out

    return one


class _Down:
    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        return other.value < self.value

    def __eq__(self, other):
        return other.value == self.value


NAMES = ["k", "a", "b"]
DATA = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 5))),
    min_size=1,
    max_size=25,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(DATA, st.booleans(), st.booleans())
def test_top_with_position(spark, data, pick_down, position_down):
    table = [(i, a, b) for i, (a, b) in enumerate(data)]
    pick = [("b", pick_down), ("k", False)]
    position = [("a", position_down), ("k", True)]
    best = sorted(table, key=key(pick, NAMES))[:5]
    ordered = sorted(table, key=key(position, NAMES))
    expected = sorted((*row, ordered.index(row) + 1) for row in best) if best else []
    df = literal_rows(spark, "k int, a int, b int", table).repartition(3)
    found = top_with_position(df, pick, 5, position).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_top_numbered(spark):
    table = [(i, i % 3, None if i == 4 else i) for i in range(10)]
    df = literal_rows(spark, "k int, a int, b int", table)
    found = top_numbered(df, [("b", True)], 3)
    assert [(r.k, r.row_number) for r in found.orderBy("row_number").collect()] == [
        (9, 1), (8, 2), (7, 3),
    ]


def test_sort_puts_null_lowest(spark):
    df = literal_rows(spark, "k int", [(1,), (None,), (2,)])
    assert [r.k for r in df.orderBy(*sort_columns([("k", False)])).collect()] == [None, 1, 2]
    assert [r.k for r in df.orderBy(*sort_columns([("k", True)])).collect()] == [2, 1, None]


@pytest.mark.parametrize("size", [0, 1, 1000])
def test_global_positions(spark, size):
    values = list(range(size))
    random.Random(7).shuffle(values)
    # One leading value on a third of the rows; the second column makes a total key.
    table = [(0 if v % 3 == 0 else v, v) for v in values]
    df = literal_rows(spark, "a int, b int", table).repartition(5)
    found = global_positions(df, ["a", "b"], "pos", start=10)
    expected = [(i, *row) for i, row in enumerate(sorted(table), 10)]
    assert rows(found) == expected
    assert "Window" not in plan_text(found.select("a", "b"))


@pytest.mark.parametrize("hot_rows", [10, 10**9])
def test_number_within(spark, hot_rows):
    table = [(None if i % 7 == 3 else ("hot" if i % 3 else f"g{i % 40}"), i * 37 % 501, i)
             for i in range(600)]
    df = literal_rows(spark, "g string, a int, b int", table).repartition(4)
    found = number_within(df, ["g"], [("a", True), ("b", False)], "rn", hot_rows=hot_rows)
    groups = {}
    for row in sorted(table, key=key([("a", True), ("b", False)], ["g", "a", "b"])):
        groups.setdefault(row[0], []).append(row)
    expected = [(*row, i) for members in groups.values() for i, row in enumerate(members, 1)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_number_copies(spark, chunk):
    table = [(1, None)] * 50 + [(2, "b")] * 3 + [(3, "c")]
    df = literal_rows(spark, "a int, b string", table).repartition(4)
    found = sorted(map(tuple, number_copies(df, "copy", chunk).collect()), key=str)
    expected = [(1, None, i) for i in range(1, 51)]
    expected += [(2, "b", i) for i in range(1, 4)] + [(3, "c", 1)]
    assert found == sorted(expected, key=str)


def test_copies_spread_over_the_partitions(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = literal_rows(spark, "a int", [(1,)] * 3000 + [(i,) for i in range(2, 100)])
    found = global_positions(df, ["a"], "pos", unique=False)
    assert [r.pos for r in found.orderBy("pos").collect()] == list(range(1, 3099))
    assert found.filter("a = 1").agg({"pos": "max"}).first()[0] == 3000
    files = spark.read.parquet(*found.inputFiles()).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] < 2000


def test_frequent_buckets_finds_the_hot_group(spark):
    table = [("hot" if i % 3 else f"g{i}", 1) for i in range(3000)]
    df = literal_rows(spark, "g string, v int", table)
    assert len(frequent_buckets(df, ["g"], 1000)) == 1
    assert frequent_buckets(df, ["g"], 5000) == []
    assert frequent_buckets(df.limit(0), ["g"], 1) == []
