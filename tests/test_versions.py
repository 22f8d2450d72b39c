"""Versioned tables, the view that merges itself, and the quarantine of events."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quern.operators.maintained import build_view
from quern.sources import versions
from quern.sources.versions import VersionedTable
from quern.streaming import quarantine, tiered_view
from quern.streaming.quarantine import QuarantineSession
from quern.streaming.tiered_view import TieredView


def test_a_reader_keeps_its_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no version"):
        table.read()
    assert table.publish(spark.range(10)) == 1
    old = table.read()
    assert table.publish(spark.range(5)) == 2
    assert (old.count(), table.read().count(), table.read(1).count()) == (10, 5, 10)
    table.forget()
    assert table.versions() == [2] and table.read().count() == 5
    folders = [f for f in versions.child_folders(spark, str(tmp_path / "t"))]
    assert len(folders) == 1


def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.publish(spark.range(10))
    broken = spark.range(10).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        table.publish(broken)
    assert table.read().count() == 10

    def die(*_):
        raise RuntimeError("killed before the pointer")

    with monkeypatch.context() as m:
        m.setattr(versions, "replace_file", die)
        with pytest.raises(RuntimeError):
            table.publish(spark.range(3))
    assert table.versions() == [1] and table.read().count() == 10
    assert table.publish(spark.range(3)) == 2 and table.read().count() == 3
    table.forget()
    assert len(versions.child_folders(spark, str(tmp_path / "t"))) == 1


def test_compaction_is_a_new_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    kind = F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b")
    df = spark.range(900).select("id", kind.alias("kind"))
    shredded = df.filter("kind = 'a'").repartition(12).unionByName(df.filter("kind = 'b'").coalesce(1))
    table.publish(shredded.unionByName(df.filter("kind IS NULL").repartition(12)), "kind")
    before = table.read()
    files = set(before.inputFiles())
    assert sorted(table.compact(), key=str) == [None, "a"]
    after = table.read()
    assert sorted(map(str, after.collect())) == sorted(map(str, before.collect())) and before.count() == 900
    kept = files & set(after.inputFiles())
    assert len(kept) == 1 and "kind=b" in kept.pop()
    assert len(after.inputFiles()) == 3 and table.compact() == []
    empty = VersionedTable(spark, str(tmp_path / "empty"))
    empty.publish(df.limit(0), "kind")
    assert empty.read().count() == 0 and empty.compact() == []


def tiered(spark, path, fan):
    return TieredView(spark, str(path), ["k"], {"v": F.col("id")}, fan=fan)


def batches(spark, n):
    return [spark.range(i * 7, i * 7 + 7).withColumn("k", F.col("id") % 5) for i in range(n)]


def expected(spark, n):
    return rows(build_view(spark.range(n * 7).withColumn("k", F.col("id") % 5), ["k"], {"v": F.col("id")}))


def test_parts_stay_few(spark, tmp_path):
    view = tiered(spark, tmp_path / "v", 3)
    with pytest.raises(ValueError, match="no part"):
        view.read()
    for i, rows_ in enumerate(batches(spark, 28)):
        view.add(rows_, i)
        assert len(view.parts()) <= 2 * 4  # fan - 1 parts of each tier
    assert [len(t) for t in view.state()["tiers"]] == [1, 0, 0, 1]  # 28 in base 3
    assert rows(view.read()) == expected(spark, 28)
    view.add(batches(spark, 28)[27], 27)  # a batch that runs again
    assert rows(view.read()) == expected(spark, 28)
    # Parts that nothing names any more are gone, but for those of the last pointer.
    assert len(versions.child_folders(spark, str(tmp_path / "v"))) <= len(view.parts()) + 3


@pytest.mark.parametrize("dies_at", [8, 5])
def test_killed_between_merge_and_pointer(spark, tmp_path, monkeypatch, dies_at):
    view = tiered(spark, tmp_path / "v", 3)
    todo = batches(spark, 10)

    def die(*_):
        raise RuntimeError("killed")

    for i, rows_ in enumerate(todo):
        if i == dies_at:
            with monkeypatch.context() as m:
                m.setattr(tiered_view, "replace_file", die)
                with pytest.raises(RuntimeError):
                    view.add(rows_, i)
            assert rows(view.read()) == expected(spark, i)
        view.add(rows_, i)
    assert rows(view.read()) == expected(spark, 10)
    assert view.sweep() and not view.sweep()
    assert rows(view.read()) == expected(spark, 10)


def test_tiers_of_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    for i, rows_ in enumerate(batches(spark, 6)):
        rows_.coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema("id long, k long").option("maxFilesPerTrigger", 1).parquet(str(source))
    view = tiered(spark, tmp_path / "v", 2)
    for _ in range(2):  # the second start has nothing new
        view.start(stream, str(tmp_path / "c"), available_now=True).awaitTermination()
    assert rows(view.read()) == expected(spark, 6) and len(view.parts()) < 6


GOOD = '<event name="rpc_completed"><data name="duration"><value>{}</value></data></event>'


def test_good_and_bad_lines_add_up(spark, tmp_path):
    source, sink = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    first = [GOOD.format(5), GOOD.format("x"), "", "   ", "rubbish", "<other/>", GOOD.format(6)[:40]]
    second = [GOOD.format(7), "<event><data name='duration'/></event>", GOOD.format("")]
    (source / "one.txt").write_text("\n".join(first) + "\n")

    def session():
        return QuarantineSession(spark, "q", str(source), str(sink), str(tmp_path / "c"))

    session().start(available_now=True).awaitTermination()
    (source / "two.txt").write_text("\n".join(second) + "\n")
    for _ in range(2):  # a restart captures nothing twice
        session().start(available_now=True).awaitTermination()
    good, bad = session().captured(), session().quarantined()
    assert good.count() + bad.count() == len(first) + len(second)
    assert sorted(r.duration or 0 for r in good.collect()) == [0, 5, 7]
    reasons = sorted((r.reason, r.file.rsplit("/", 1)[1], r.payload) for r in bad.collect())
    assert reasons == sorted([
        (quarantine.MISTYPED, "one.txt", first[1]), (quarantine.EMPTY, "one.txt", ""),
        (quarantine.EMPTY, "one.txt", "   "), (quarantine.BROKEN, "one.txt", "rubbish"),
        (quarantine.NAMELESS, "one.txt", "<other/>"), (quarantine.BROKEN, "one.txt", first[6]),
        (quarantine.NAMELESS, "two.txt", second[1]),
    ])


def test_a_batch_that_runs_again_replaces_its_lines(spark, tmp_path):
    session = QuarantineSession(spark, "q", "", str(tmp_path / "out"), "", events=["rpc_completed"], where=F.col("duration") > 5)
    lines = [(GOOD.format(i), "f") for i in range(10)] + [("bad", "f")]
    frame = spark.createDataFrame(lines, "payload string, file string")
    for _ in range(2):
        session._write(frame, 3)
    session._write(spark.createDataFrame([("bad", "f")], frame.schema), 4)
    assert session.captured().count() == 4 and session.quarantined().count() == 2
