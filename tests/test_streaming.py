"""Streams against their batch result, across restarts and repeated batches."""

from conftest import rows
from pyspark.sql import functions as F

from quern.functions.numeric import cents
from quern.operators.maintained import apply_delta, build_view
from quern.plans.telemetry import BATCH_EVENT, CALL_EVENT
from quern.sources.event_files import write_event_lines
from quern.sources.literals import literal_rows
from quern.streaming.event_session import LATENCY, EventSession
from quern.streaming.live_view import LiveView


def _lines(spark, path, events):
    source = literal_rows(spark, "name string, n int", events)
    write_event_lines(source, path, F.col("name"), {"duration": F.col("n")})


def test_session_filters_and_resumes(spark, tmp_path):
    incoming = tmp_path / "incoming"
    session = EventSession(
        spark, "capture", f"{incoming}/*", str(tmp_path / "sink"), str(tmp_path / "check"),
        events=[CALL_EVENT], where=F.col("duration") >= 10,
    )
    _lines(spark, f"{incoming}/1", [(CALL_EVENT, 10), (CALL_EVENT, 5), (BATCH_EVENT, 50)])
    session.start(available_now=True).awaitTermination()
    assert [r.duration for r in session.captured().collect()] == [10]
    _lines(spark, f"{incoming}/2", [(CALL_EVENT, 20)])
    session.start(available_now=True).awaitTermination()
    session.start(available_now=True).awaitTermination()
    assert sorted(r.duration for r in session.captured().collect()) == [10, 20]


def test_session_start_and_stop(spark, tmp_path):
    incoming = str(tmp_path / "incoming")
    _lines(spark, incoming, [(CALL_EVENT, 1)])
    session = EventSession(
        spark, "running", incoming, str(tmp_path / "sink"), str(tmp_path / "check")
    )
    query = session.start()
    assert query.isActive and LATENCY == "30 seconds"
    query.processAllAvailable()
    session.stop()
    assert not query.isActive and session.captured().count() == 1


KEYS = ["event_type"]


def _sums():
    return {"total": cents(F.col("value"))}


def test_live_view_equals_batch(spark, tables, tmp_path):
    source = str(tmp_path / "rows")
    events = tables.events.select("event_type", "value")
    events.repartition(5).write.parquet(source)
    view = LiveView(spark, str(tmp_path / "view"), KEYS, _sums())

    def drain():
        stream = (
            spark.readStream.schema(events.schema)
            .option("maxFilesPerTrigger", 1)
            .parquet(source)
        )
        view.start(stream, str(tmp_path / "check"), available_now=True).awaitTermination()

    drain()
    assert rows(view.read()) == rows(build_view(events, KEYS, _sums()))
    events.limit(50).coalesce(1).write.mode("append").parquet(source)
    drain()
    both = spark.read.parquet(source)
    assert rows(view.read()) == rows(build_view(both, KEYS, _sums()))


def test_repeated_batch_counts_once(spark, tables, tmp_path):
    events = tables.events.select("event_type", "value")
    view = LiveView(spark, str(tmp_path / "view"), KEYS, _sums())
    for batch in (0, 1, 1):
        view._write(events, batch)
    twice = build_view(events.unionAll(events), KEYS, _sums())
    assert rows(view.read()) == rows(twice)


def test_delta_drops_empty_groups(spark):
    def table(*values):
        return literal_rows(spark, "k string, v bigint", values)

    sums = {"total": F.col("v")}
    view = build_view(table(("a", 5), ("b", -5), ("b", 5)), ["k"], sums)
    # Group b sums to zero and stays, group a loses its only row and goes.
    after = apply_delta(view, ["k"], sums, inserted=table(("c", 1)), deleted=table(("a", 5)))
    assert rows(after) == [("b", 0, 2), ("c", 1, 1)]
    assert rows(apply_delta(view, ["k"], sums)) == rows(view)


def test_folded_view_survives_a_repeated_batch(spark, tables, tmp_path):
    events = tables.events.select("event_type", "value")
    view = LiveView(spark, str(tmp_path / "view"), KEYS, _sums())
    for batch in range(3):
        view._write(events, batch)
    folded = view.fold(str(tmp_path / "folded"))
    assert rows(folded.read()) == rows(view.read())
    folded._write(events, 2)
    assert rows(folded.read()) == rows(view.read())
    folded._write(events, 3)
    again = folded.fold(str(tmp_path / "again"))
    four = build_view(events.unionAll(events).unionAll(events).unionAll(events), KEYS, _sums())
    assert rows(again.read()) == rows(four)
