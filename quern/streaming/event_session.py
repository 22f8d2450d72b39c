"""A named capture session over event files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.plans.telemetry import shred_events

# Fixed value: the dispatch latency of a session.
LATENCY = "30 seconds"


class EventSession:
    """Reads new event files, keeps wanted events and appends typed rows.

    A backlog is taken in micro-batches of at most about ``bytes_per_batch``.  The
    session is stateless: each micro-batch is a map-only job, and the sink's
    commit log with the checkpoint makes the output exactly-once.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        source: str,
        sink: str,
        checkpoint: str,
        events: Sequence[str] | None = None,
        where: Column | None = None,
        bytes_per_batch: int | None = None,
    ):
        self.spark = spark
        self.name = name
        self.source = source
        self.sink = sink
        self.checkpoint = checkpoint
        self.events = events
        self.where = where
        self.bytes_per_batch = bytes_per_batch
        self.query: StreamingQuery | None = None

    def stream(self) -> DataFrame:
        reader = self.spark.readStream.format("text")
        if self.bytes_per_batch is not None:
            reader = reader.option("maxBytesPerTrigger", self.bytes_per_batch)
        payloads = reader.load(self.source).select(F.col("value").alias("payload"))
        rows = shred_events(payloads)
        if self.events is not None:
            rows = rows.filter(F.col("event_name").isin(list(self.events)))
        return rows if self.where is None else rows.filter(self.where)

    def start(self, available_now: bool = False) -> StreamingQuery:
        """Start capturing; ``available_now`` drains what is there and stops."""
        writer = (
            self.stream()
            .writeStream.queryName(self.name)
            .format("parquet")
            .option("path", self.sink)
            .option("checkpointLocation", self.checkpoint)
            .outputMode("append")
        )
        if available_now:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=LATENCY)
        self.query = writer.start()
        return self.query

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()

    def captured(self) -> DataFrame:
        """What the session has written so far."""
        schema = shred_events(
            self.spark.createDataFrame([], "payload string")
        ).schema
        return self.spark.read.schema(schema).parquet(self.sink)
