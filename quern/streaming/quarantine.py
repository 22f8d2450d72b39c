"""Capture of events that keeps what it cannot read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.functions.xml import EVENT_SCHEMA, event_field
from quern.plans.telemetry import HASHES, MEASURES, shred_events, shred_parsed
from quern.streaming.event_session import LATENCY, EventSession

# Why a line is put aside.
EMPTY = "empty line"
BROKEN = "not an event document"
NAMELESS = "no event name"
MISTYPED = "a field of another type"

_CORRUPT = "_corrupt_record"


def _mistyped(event: Column) -> Column:
    """Whether a typed field holds text, other than blanks, that its type does not take."""
    checks = []
    for names, kind in ((MEASURES, "bigint"), (HASHES, "binary")):
        for name in names:
            given = event_field(event, name)
            checks.append((F.trim(given) != "") & event_field(event, name, kind).isNull())
    return reduce(lambda a, b: a | b, checks)


def judge_events(lines: DataFrame) -> DataFrame:
    """Typed columns of each line, and the ``reason`` why it cannot be read, or NULL.

    ``lines`` has ``payload`` and ``file``; a line is parsed once.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    schema = f"{EVENT_SCHEMA}, {_CORRUPT} STRING"
    parsed = lines.withColumn("event", F.from_xml("payload", schema, options))
    event = F.col("event")
    reason = (
        F.when(F.coalesce(F.trim("payload"), F.lit("")) == "", EMPTY)
        .when(event.isNull() | event[_CORRUPT].isNotNull(), BROKEN)
        .when(event["_name"].isNull(), NAMELESS)
        .when(F.coalesce(_mistyped(event), F.lit(False)), MISTYPED)
    )
    return shred_parsed(
        parsed.withColumn("reason", reason), keep=("reason", "payload", "file")
    )


class QuarantineSession(EventSession):
    """An event session that writes unreadable lines to a second folder.

    Each micro-batch is parsed and written in one pass, readable events and broken lines
    side by side in a folder of the batch, which a batch that runs again replaces.  So
    every line is in exactly one of both, also after a restart, and their counts add up
    to the lines that were read, apart from events that the session was told to leave
    out.
    """

    def lines(self) -> DataFrame:
        reader = self.spark.readStream.format("text")
        if self.bytes_per_batch is not None:
            reader = reader.option("maxBytesPerTrigger", self.bytes_per_batch)
        return reader.load(self.source).select(
            F.col("value").alias("payload"), F.col("_metadata.file_path").alias("file")
        )

    def _wanted(self) -> Column:
        wanted = F.lit(True)
        if self.events is not None:
            wanted = wanted & F.col("event_name").isin(list(self.events))
        return wanted if self.where is None else wanted & self.where

    def _write(self, lines: DataFrame, batch: int) -> None:
        good = F.col("reason").isNull()
        rows = judge_events(lines).filter(~good | F.coalesce(self._wanted(), F.lit(False)))
        (
            rows.withColumn("payload", F.when(~good, F.col("payload")))
            .withColumn("file", F.when(~good, F.col("file")))
            .withColumn("outcome", F.when(good, "captured").otherwise("quarantined"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("outcome")
            .parquet(f"{self.sink}/batch_id={batch}")
        )

    def start(self, available_now: bool = False) -> StreamingQuery:
        writer = (
            self.lines()
            .writeStream.queryName(self.name)
            .foreachBatch(self._write)
            .option("checkpointLocation", self.checkpoint)
        )
        if available_now:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=LATENCY)
        self.query = writer.start()
        return self.query

    def _stored(self, outcome: str) -> DataFrame:
        event = shred_events(self.spark.createDataFrame([], "payload string")).schema
        schema = "reason string, payload string, file string, outcome string, batch_id long"
        for field in event.fields:
            schema += f", {field.name} {field.dataType.simpleString()}"
        stored = self.spark.read.schema(schema).option("basePath", self.sink).parquet(self.sink)
        return stored.filter(F.col("outcome") == outcome)

    def captured(self) -> DataFrame:
        columns = shred_events(self.spark.createDataFrame([], "payload string")).columns
        return self._stored("captured").select(*columns)

    def quarantined(self) -> DataFrame:
        """Raw lines that could not be read, with their file, reason and batch."""
        return self._stored("quarantined").select("batch_id", "file", "reason", "payload")
