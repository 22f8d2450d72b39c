"""Joins of frequent keys, declared domains, trusted references, clustered tables."""

import pyarrow.parquet as pq
import pytest
from __spark_entry__ import queries
from conftest import plan_text, rows
from pyspark.sql import functions as F

from quern.operators.domains import DomainError, Domains, Interval, between, exactly
from quern.operators.joins import fits, join_by, latest_per_key
from quern.operators.skew import heavy_buckets, skew_join
from quern.operators.trust import BrokenReference, TrustedReferences, verify_reference
from quern.operators.zorder import interleaved, write_clustered


def two_sided(spark, hot_left=600, hot_right=400):
    left = [(7, f"l{i}") for i in range(hot_left)] + [(i, f"s{i}") for i in range(50)]
    right = [(7, f"r{i}") for i in range(hot_right)] + [(i, f"t{i}") for i in range(20, 80)]
    left += [(None, "n")] * 5 + [(8, "alone")] * 300
    right += [(None, "n")] * 5 + [(90, "unused")] * 300
    return (
        spark.createDataFrame(left, "a int, x string").repartition(3),
        spark.createDataFrame(right, "b int, y string").repartition(3),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_frequent_on_both_sides(spark, conf, how):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    left, right = two_sided(spark)
    found = skew_join(left, right, ["a"], ["b"], how, rows=100)
    plain = left.join(right, F.col("a") == F.col("b"), how)
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    heavy, limit = heavy_buckets(left, ["a"], right, ["b"], 100)
    assert limit == 100 and len(heavy) >= 3
    # Pairs of the frequent key are made by key and fragments, not by key alone.
    assert "__left" in plan_text(found) and "__right" in plan_text(found)
    joined = found.filter("a = 7 AND y IS NOT NULL").groupBy(F.spark_partition_id()).count()
    counts = [r["count"] for r in joined.collect()]
    assert sum(counts) == 601 * 400 and max(counts) < 601 * 400 / 2


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("swapped", [False, True])
def test_few_rows_go_to_the_many(spark, conf, how, swapped):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    many = [(7, f"m{i}") for i in range(900)] + [(9, "alone")] * 300 + [(None, "n")] * 300
    few = [(7, "f0"), (7, "f1"), (3, "g"), (None, "n")]
    left, right = (few, many) if swapped else (many, few)
    left = spark.createDataFrame(left, "a int, x string").repartition(6)
    right = spark.createDataFrame(right, "b int, y string").repartition(6)
    found = skew_join(left, right, ["a"], ["b"], how, rows=100)
    plain = left.join(right, F.col("a") == F.col("b"), how)
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    assert "__left" not in plan_text(found) and "BroadcastHashJoin" in plan_text(found)
    joined = found.filter("a = 7").groupBy(F.spark_partition_id()).count()
    counts = [r["count"] for r in joined.collect()]
    assert sum(counts) == 1800 and max(counts) < 900


@pytest.mark.parametrize("how", ["inner", "left"])
def test_more_than_few_rows_are_cut(spark, conf, how, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr("quern.operators.skew.FEW_ROWS", 1)
    left = spark.createDataFrame([(7, i) for i in range(900)] + [(8, 0)] * 300, "a int, x int")
    right = spark.createDataFrame([(7, 1), (7, 2), (8, 3)], "b int, y int")
    found = skew_join(left, right, ["a"], ["b"], how, rows=100)
    plain = left.join(right, F.col("a") == F.col("b"), how)
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    assert "__left" in plan_text(found)


@pytest.mark.parametrize("name", ["join_skew", "join_skew_one_key"])
def test_opposite_frequent_keys_spread(spark, tmp_path, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__files__openCostInBytes="64m")
    for table, key in (("orders", "o_orderkey"), ("events", "event_id")):
        made = spark.range(40_000).withColumnRenamed("id", key)
        made.repartition(8).write.parquet(str(tmp_path / f"{table}.parquet"))
    found = queries()[name](spark, str(tmp_path))
    per_task = found.groupBy("c", F.spark_partition_id()).count()
    counts = {}
    for row in per_task.collect():
        counts.setdefault(row["c"], []).append(row["count"])
    assert {c: sum(n) for c, n in counts.items()} == (
        {1: 39_999, 2: 39_999} if name == "join_skew" else {2: 39_999}
    )
    assert all(max(n) < 20_000 for n in counts.values())


def test_ordinary_keys_join_as_usual(spark):
    left, right = two_sided(spark, 3, 3)
    assert "__left" not in plan_text(skew_join(left, right, ["a"], ["b"], rows=1000))
    with pytest.raises(ValueError, match="both sides"):
        skew_join(left, left, ["a"], ["a"])
    with pytest.raises(ValueError, match="unknown join"):
        skew_join(left, right, ["a"], ["b"], "outer")


def test_intervals():
    assert between(1, 5).meet(between(3, 9)) == between(3, 5)
    assert exactly(6).meet(between(1, 5)).empty
    assert Interval(5, 9, low_closed=False).meet(between(1, 5)).empty
    assert Interval(1, 5, high_closed=False).meet(exactly(5)).empty
    assert not Interval(low=3).meet(Interval(high=3)).empty
    assert between(0, 10).holds(between(1, 5)) and not between(2, 10).holds(between(1, 5))
    assert Interval().holds(between(1, 5)) and between(3, 2).empty


def scans(df):
    return [line for line in plan_text(df).splitlines() if "FileScan" in line]


def test_a_predicate_outside_the_domain_scans_nothing(tables):
    domains = Domains({"p_size": between(1, 50)}).verify(tables.part)
    for asked in (exactly(60), Interval(50, None, low_closed=False), [between(1, 9), between(20, 30)]):
        df = domains.filter(tables.part, {"p_size": asked})
        assert scans(df) == [] and df.isEmpty() and df.columns == tables.part.columns
    inside = domains.filter(tables.part, {"p_size": exactly(20)})
    assert len(scans(inside)) == 1 and inside.count() == tables.part.filter("p_size = 20").count()
    whole = plan_text(domains.filter(tables.part, {"p_size": between(0, 99)}))
    assert "isnotnull(p_size" in whole and "99" not in whole


def test_null_passes_the_check_but_not_the_predicate(spark):
    df = spark.createDataFrame([(None,), (12,), (20,)], "c int")
    domains = Domains({"c": between(10, 20)}).verify(df)
    assert rows(domains.filter(df, {"c": between(0, 100)})) == [(12,), (20,)]
    with pytest.raises(DomainError, match="'c': 1"):
        Domains({"c": between(10, 15)}).verify(df)


def test_trusted_references_need_no_join(spark, tmp_path):
    path = str(tmp_path / "child")
    spark.createDataFrame([(1, 10), (2, 11), (3, 10)], "id int, ref int").write.parquet(path)
    spark.createDataFrame([(10, "a"), (11, "b")], "key int, name string").write.parquet(str(tmp_path / "parent"))
    child, parent = spark.read.parquet(path), spark.read.parquet(str(tmp_path / "parent"))
    known = TrustedReferences(spark, str(tmp_path / "trust.json"))

    def joined(c, columns=()):
        return known.with_parent("ref", c, ["ref"], parent, ["key"], columns)

    assert "Semi" in plan_text(joined(child))
    known.trust("ref", verify_reference(child, ["ref"], parent, ["key"]))
    assert "Join" not in plan_text(joined(child)) and joined(child).count() == 3
    assert "Join" in plan_text(joined(child, ["name"]))
    assert rows(joined(child, ["name"])) == [(1, 10, "a"), (2, 11, "b"), (3, 10, "a")]
    # New rows make the trust stale: it is not believed, and the orphan is dropped.
    spark.createDataFrame([(4, 12)], "id int, ref int").write.mode("append").parquet(path)
    newer = spark.read.parquet(path)
    assert not known.holds("ref", newer, parent)
    assert "Semi" in plan_text(joined(newer)) and joined(newer).count() == 3


@pytest.mark.parametrize("child, parent, what", [
    ([1], [1, 1], "repeated"), ([1], [1, None], "without value"),
    ([1, None], [1], "without reference"), ([1, 2], [1], "missing"),
])
def test_broken_references_are_refused(spark, child, parent, what):
    c = spark.createDataFrame([(x,) for x in child], "ref int")
    p = spark.createDataFrame([(x,) for x in parent], "key int")
    with pytest.raises(BrokenReference, match=what):
        verify_reference(c, ["ref"], p, ["key"])


def test_broadcast_is_bounded_by_bytes(spark, tables, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    wide = tables.customer.select("c_custkey", F.repeat(F.lit("x"), 10_000).alias("w"))
    on = F.col("o_custkey") == F.col("c_custkey")
    assert fits(wide, 1000, 10_000_000) and not fits(wide, 1000, 100_000)
    assert not fits(wide, 10, 10_000_000)
    assert "BroadcastHashJoin" in plan_text(join_by(tables.orders, wide, on, "broadcast"))
    narrow = join_by(tables.orders, wide, on, "broadcast", broadcast_bytes=100_000)
    assert "BroadcastHashJoin" not in plan_text(narrow)


def test_latest_in_one_pass(tables):
    orders = tables.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    once = latest_per_key(orders, "o_custkey", "o_orderkey", unique=True)
    assert plan_text(once).count("FileScan") == 1 and plan_text(once).count("Exchange") == 1
    assert rows(once) == rows(latest_per_key(orders, "o_custkey", "o_orderkey"))
    names = tables.customer.select("c_custkey", "c_name")
    both = [
        latest_per_key(orders, "o_custkey", "o_orderkey", names, "c_custkey", unique=u)
        for u in (True, False)
    ]
    assert rows(both[0]) == rows(both[1])


def test_latest_in_one_pass_with_nulls(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (2, None), (2, 5), (2, 4)], "k int, o int")
    for unique in (True, False):
        assert rows(latest_per_key(df, "k", "o", unique=unique)) == [(2, 5)]


def test_bits_are_interleaved(spark):
    ranks = spark.createDataFrame([(5, 3), (0, 7), (7, 0)], "a int, b int")
    found = [r[0] for r in ranks.select(interleaved([F.col("a"), F.col("b")], 3)).collect()]
    assert found == [0b100111, 0b010101, 0b101010]


def test_every_clustering_column_skips_row_groups(spark, tmp_path):
    n = 40_000
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("a"),
        F.when(F.col("id") % 50 > 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000))).alias("b"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(10**6))).alias("c"), "id",
    ).repartition(4)
    path = str(tmp_path / "t")
    back = write_clustered(df, path, ["a", "b", "c"], ["id"], bits=6, block_bytes=64 * 1024)
    assert back.count() == n and back.exceptAll(df).isEmpty()

    def read_share(folder, column, low, high):
        kept = total = 0
        for file in spark.read.parquet(folder).inputFiles():
            meta = pq.ParquetFile(file.removeprefix("file://")).metadata
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                place = next(i for i in range(group.num_columns) if group.column(i).path_in_schema == column)
                stats = group.column(place).statistics
                total += group.num_rows
                kept += group.num_rows * (stats.min <= high and stats.max >= low)
        return kept / total

    spark.conf.set("spark.sql.shuffle.partitions", "4")
    for column in ("a", "b"):
        assert read_share(path, column, 100, 110) < 0.6
    plain = str(tmp_path / "plain")
    df.repartitionByRange("a").sortWithinPartitions("a").write.option(
        "parquet.block.size", 64 * 1024
    ).parquet(plain)
    assert read_share(plain, "b", 100, 110) > 0.95
