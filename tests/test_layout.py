"""Files on storage: order, buckets, compaction."""

from __spark_entry__ import queries
from conftest import DATA, plan_text, rows
from pyspark.sql import functions as F

from quern.operators import layout


def test_ordered_files_do_not_overlap(spark, tables, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    found = layout.write_ordered(
        tables.lineitem, str(tmp_path / "t"), ["l_partkey"], ["l_orderkey"], "zstd"
    )
    assert found.count() == tables.lineitem.count()
    bounds = sorted(
        (r.low, r.high)
        for r in found.groupBy(F.input_file_name())
        .agg(F.min("l_partkey").alias("low"), F.max("l_partkey").alias("high"))
        .collect()
    )
    assert len(bounds) > 1
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
    assert all(".zstd." in f for f in found.inputFiles())


def test_one_frequent_key_spreads_over_files(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(10_000).select(F.lit(1).alias("k"), "id")
    found = layout.write_ordered(df, str(tmp_path / "t"), ["k"], ["id"])
    assert len(found.inputFiles()) > 1


def test_copies_of_one_row_spread_over_files(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(10_000).select(F.lit(1).alias("k"))
    found = layout.write_ordered(df, str(tmp_path / "t"), ["k"], unique=False)
    assert found.count() == 10_000 and len(found.inputFiles()) > 1


def test_bucketed_join_needs_no_shuffle(spark, tables, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    orders = layout.write_bucketed(
        tables.orders, "bucketed_orders", str(tmp_path / "o"), ["o_orderkey"], 4
    )
    lines = layout.write_bucketed(
        tables.lineitem, "bucketed_lines", str(tmp_path / "l"), ["l_orderkey"], 4
    )
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    assert "Exchange" not in plan_text(joined)
    assert joined.count() == tables.lineitem.count()


def test_covering_extract(spark, tables, tmp_path):
    found = layout.covering_extract(
        tables.orders, ["o_custkey"], ["o_orderdate"], str(tmp_path / "x"),
        where=F.col("o_orderstatus") == "F", unique=False,
    )
    assert found.columns == ["o_custkey", "o_orderdate"]
    assert found.count() == tables.orders.filter("o_orderstatus = 'F'").count()


def test_report_classes(spark):
    def files(name, small, large):
        return [(name, i, 10 if i < small else 1000) for i in range(small + large)]

    made = files("few", 3, 0) + files("calm", 2, 18) + files("light", 6, 14)
    made += files("edge", 8, 12) + files("bad", 9, 11)
    sizes = spark.createDataFrame(made, "part string, file int, bytes bigint")
    real = layout.file_sizes
    layout.file_sizes = lambda df, partition: df.withColumn("n_rows", F.lit(1).cast("bigint"))
    try:
        report = layout.layout_report(sizes, "part", target_bytes=1000)
        actions = {r.part: r.action for r in report.collect()}
    finally:
        layout.file_sizes = real
    assert actions == {
        "few": "keep", "calm": "keep", "light": "merge", "edge": "merge", "bad": "rebuild",
    }


def test_compaction_rewrites_only_listed_partitions(spark, tables, tmp_path):
    path = str(tmp_path / "t")
    lines = tables.lineitem.select("l_orderkey", "l_quantity", "l_returnflag")
    shredded = lines.filter("l_returnflag = 'R'").repartition(12)
    shredded.unionByName(lines.filter("l_returnflag <> 'R'").coalesce(1)).write.partitionBy(
        "l_returnflag"
    ).parquet(path)
    before = spark.read.parquet(path)
    kept = {f for f in before.inputFiles() if "=R" not in f}
    assert layout.compact(before, path, "l_returnflag", 1 << 20) == ["R"]
    after = spark.read.parquet(path)
    assert {f for f in after.inputFiles() if "=R" not in f} == kept
    assert len([f for f in after.inputFiles() if "=R" in f]) < 12
    assert rows(after.select(*lines.columns)) == rows(lines)
    assert layout.compact(after, path, "l_returnflag", 1 << 20) == []


def test_compaction_of_the_partition_without_value(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(600).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit("even")).alias("kind")
    )
    table.repartition(12).write.partitionBy("kind").parquet(path)
    assert sorted(layout.compact(spark.read.parquet(path), path, "kind"), key=str) == [
        None, "even",
    ]
    after = spark.read.parquet(path)
    assert len(after.inputFiles()) == 2
    assert sorted(map(tuple, after.collect()), key=str) == sorted(
        map(tuple, table.collect()), key=str
    )


def test_every_piece_has_a_task_of_its_own(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "t")
    table = spark.range(8_000).select("id", (F.col("id") % 2).alias("kind"))
    table.repartition(4).write.partitionBy("kind").parquet(path)
    stored = spark.read.parquet(path)
    listed = spark.createDataFrame([(0, 500), (1, 1100)], "kind int, total_bytes bigint")
    pieces = layout.target_pieces(stored, "kind", listed.collect(), listed.schema, 100)
    assert "Sort" not in plan_text(pieces)
    per_task = pieces.groupBy(F.spark_partition_id(), "kind").count().collect()
    assert sorted(r.kind for r in per_task) == [0] * 5 + [1] * 11
    assert len({r[0] for r in per_task}) == 16
    assert all(r["count"] < 2 * 4_000 / (5 if r.kind == 0 else 11) for r in per_task)
    assert rows(pieces.select("id")) == rows(table.select("id"))


def test_unsorted_files(spark, tmp_path):
    name, path = "spark.sql.maxConcurrentOutputFileWriters", str(tmp_path / "t")
    spark.sql(
        f"CREATE TABLE pieces_of (id BIGINT, kind INT) USING parquet "
        f"PARTITIONED BY (kind) LOCATION '{path}'"
    )
    insert = "EXPLAIN INSERT INTO pieces_of SELECT id, CAST(id % 2 AS INT) FROM range(9)"
    assert "Sort" in spark.sql(insert).first()[0]
    with layout.unsorted_files(spark):
        assert "Sort" not in spark.sql(insert).first()[0]
        with layout.unsorted_files(spark):
            pass
        assert spark.conf.get(name) == "1"
    assert "Sort" in spark.sql(insert).first()[0]
    spark.sql("DROP TABLE pieces_of")


def test_whole_partitions_stay_whole_with_many_shuffle_partitions(spark, conf):
    conf(spark__sql__shuffle__partitions="320")
    found = queries()["layout_report"](spark, DATA)
    assert {r.l_returnflag: (r.first_action, r.second_action) for r in found.collect()} == {
        "A": ("keep", "keep"), "N": ("keep", "keep"), "R": ("rebuild", "keep"),
    }


def test_report_without_a_shredded_partition(spark, tables, tmp_path):
    lines = tables.lineitem.filter("l_returnflag IS DISTINCT FROM 'R'")
    lines = lines.withColumn("l_returnflag", F.expr("nullif(l_returnflag, 'N')"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = queries()["layout_report"](spark, str(tmp_path))
    counts = {r.l_returnflag: r.n_rows for r in found.filter("first_action = 'keep'").collect()}
    assert counts == {r[0]: r[1] for r in lines.groupBy("l_returnflag").count().collect()}
