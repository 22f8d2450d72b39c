"""Readers, writers and event files."""

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from quern.operators.joins import apply_keyed, pair_with_few, unique_names, where_key_exists
from quern.operators.joins import latest_per_key
from quern.operators.loads import key_report, missing_values, orphans, repeated_keys
from quern.plans.table_functions import register_table_functions
from quern.plans.telemetry import shred_events, shred_parsed, statement_templates
from quern.session import materialize, shared_folder
from quern.sources.event_files import (
    read_event_documents,
    read_event_lines,
    write_event_lines,
)
from quern.sources.literals import literal_rows
from quern.sources.sinks import create_table_as, declare_table, insert_into
from quern.sources.tables import Tables, scan


def test_tables_and_scan(spark):
    assert Tables(spark, DATA + "/").region.count() == 5
    assert scan(spark, f"{DATA}/region.parquet", ["r_name"]).columns == ["r_name"]


def test_shared_folder_follows_the_cluster(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(root) and first != second


def test_create_table_twice(spark, tmp_path):
    df = literal_rows(spark, "k int", [(1,)])
    create_table_as(df, "made_once", str(tmp_path / "a"), replace=True)
    with pytest.raises(Exception, match="already exists"):
        create_table_as(df, "made_once", str(tmp_path / "b"))
    again = create_table_as(
        df.withColumn("v", F.lit("x")), "made_once", str(tmp_path / "c"), replace=True
    )
    assert rows(again) == [(1, "x")]


def test_insert_by_listed_columns(spark):
    declare_table(spark, "filled", "a string, b int, c int DEFAULT 7")
    found = insert_into(literal_rows(spark, "x int, y string", [(1, "p")]), "filled", ["b", "a"])
    found = insert_into(literal_rows(spark, "y string", [("q",)]), "filled", ["a"])
    assert found.count() == 2
    assert sorted(found.collect(), key=str) == [("p", 1, 7), ("q", None, 7)]


def test_materialize_fixes_values(spark):
    df = materialize(spark.range(100).withColumn("r", F.rand()), "random")
    assert rows(df) == rows(df)


LINE = (
    '<event name="{name}" package="p"><data name="duration"><type name="int64"/>'
    "<value>{duration}</value></data>{more}</event>"
)


def test_shredding_rules(spark, tmp_path):
    lines = [
        LINE.format(
            name="sql_batch_completed", duration=7,
            more='<data name="batch_text"><value>SELECT 1 &lt; 2 &amp; "x"</value></data>'
            '<data name="statement"><value>wrong one</value></data>',
        ),
        LINE.format(
            name="rpc_completed", duration="",
            more='<data name="statement"><value>EXEC p</value></data>'
            '<data name="query_hash"><value>00FF</value></data>'
            '<data name="cpu_time"><value>5</value></data>'
            '<data name="cpu_time"><value>6</value></data>',
        ),
        LINE.format(name="login", duration="many", more=""),
        "<event broken",
    ]
    (tmp_path / "one.txt").write_text("\n".join(lines[:2]))
    (tmp_path / "two.txt").write_text("\n".join(lines[2:]))
    found = shred_events(read_event_lines(spark, str(tmp_path / "*.txt")))
    batch, call, login, broken = (
        found.orderBy(F.col("event_name").desc_nulls_last()).collect()
    )
    assert (batch.duration, batch.sql_text) == (7, 'SELECT 1 < 2 & "x"')
    assert batch.physical_reads is None and batch.query_hash is None
    assert (call.sql_text, call.cpu_time, call.duration) == ("EXEC p", 5, None)
    assert bytes(call.query_hash) == b"\x00\xff"
    assert (login.event_name, login.duration, login.sql_text) == ("login", None, None)
    assert broken.event_name is None


def test_documents_over_several_lines(spark, tmp_path):
    body = LINE.format(name="rpc_completed", duration=3, more="").replace("><", ">\n<")
    (tmp_path / "e.xml").write_text(f"<events>\n{body}\n{body}\n</events>")
    found = shred_parsed(read_event_documents(spark, str(tmp_path / "*.xml")))
    assert [(r.event_name, r.duration) for r in found.collect()] == [("rpc_completed", 3)] * 2


def test_written_events_come_back(spark, tmp_path):
    source = literal_rows(spark, "n int, s string", [(1, "a<b>&\"c\""), (2, None)])
    path = write_event_lines(
        source, str(tmp_path / "ev"), F.lit("rpc_completed"),
        {"duration": F.col("n"), "statement": F.col("s")},
    )
    found = shred_events(read_event_lines(spark, path)).select("duration", "sql_text")
    assert sorted(found.collect(), key=str) == [(1, 'a<b>&"c"'), (2, None)]


def test_statement_templates(spark):
    texts = literal_rows(
        spark,
        "t string",
        [("SELECT a FROM t WHERE id = 42",), ("select a  from T where ID = 52.5",),
         ("select a from t where id = 'x 1'",), ("select a1 from t",)],
    )
    found = {r.template: r.executions for r in statement_templates(texts, "t").collect()}
    assert found == {"select a from t where id = ?": 3, "select a1 from t": 1}


def test_latest_keeps_ties_and_drops_null_keys(spark):
    table = literal_rows(
        spark, "k int, o int, v string",
        [(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d"), (3, None, "e"), (None, 9, "f")],
    )
    assert [r[2] for r in rows(latest_per_key(table, "k", "o"))] == ["a", "b", "d"]


def test_pairing_with_a_short_list(spark):
    left = literal_rows(spark, "k int", [(1,), (2,)])
    few = literal_rows(spark, "name string, d double", [("x", 1.5), (None, None)])
    found = pair_with_few(left, few)
    assert found.columns == ["k", "name", "d"] and found.count() == 4
    assert found.schema["d"].dataType == few.schema["d"].dataType
    assert pair_with_few(left, few.limit(0)).count() == 0
    with pytest.raises(ValueError, match="more than 1 rows"):
        pair_with_few(left, few, max_few=1)


def test_lookup_with_and_without_match(spark):
    left = literal_rows(spark, "k int", [(1,), (2,)])
    keyed = literal_rows(spark, "k int, t string", [(1, "one"), (1, "uno")])
    assert apply_keyed(left, keyed, "k").count() == 2
    assert apply_keyed(left, keyed, "k", keep_unmatched=True).count() == 3
    assert where_key_exists(left, keyed, "k").count() == 1


def test_unique_names(spark):
    left = literal_rows(spark, "k int", [(1,)])
    joined = unique_names(left, "a_").join(unique_names(left, "b_"), F.col("a_k") == F.col("b_k"))
    assert joined.columns == ["a_k", "b_k"]


def test_key_rules(spark):
    child = literal_rows(spark, "k int, p int", [(1, 1), (1, 2), (2, None), (3, 9)])
    parent = literal_rows(spark, "p int", [(1,), (2,), (2,)])
    assert rows(repeated_keys(child, ["k"])) == [(1, 2)]
    assert missing_values(child, ["k", "p"]).first() == (0, 1)
    lost = orphans(child, "p", parent, "p")
    assert rows(lost) == [(3, 9)]
    assert rows(key_report({"lost": lost, "twice": repeated_keys(parent, ["p"])})) == [
        ("lost", 1), ("twice", 1),
    ]


def test_table_functions(spark, tables):
    register_table_functions(spark, tables)
    expected = tables.orders.filter("o_custkey = 42").count()
    assert spark.sql("SELECT * FROM orders_of(42)").count() == expected > 0


def test_clear_shared_folder(spark):
    from quern.session import clear_shared

    path = shared_folder(spark, "gone")
    spark.range(3).write.parquet(path)
    clear_shared(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_cluster_without_shared_folder_is_refused():
    from quern.session import _shared_root

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _shared_root(Session())


def test_settings_grow_with_the_input():
    from quern.session import sized_for

    small, large = sized_for(10 * 1024**2, 8), sized_for(100 * 1024**4, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert large["spark.sql.shuffle.partitions"] == "100000"
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 512 * 1024**2


def test_tables_of_a_database(spark, tables, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    create_table_as(tables.region, "shop.region", str(tmp_path / "r"), replace=True)
    assert Tables(spark, database="shop").region.count() == 5


def test_a_replacement_that_dies_leaves_the_old_table(spark, tmp_path):
    create_table_as(spark.range(3), "made_safe", replace=True)
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        create_table_as(broken, "made_safe", replace=True)
    assert spark.table("made_safe").count() == 3
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf")
    for n in (5, 4):
        assert create_table_as(spark.range(n), "shelf.made_safe", replace=True).count() == n
    assert create_table_as(spark.range(7), "made_safe", replace=True).count() == 7
    assert spark.table("shelf.made_safe").count() == 4
