"""A grouped aggregate kept up to date from a stream of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.operators.maintained import build_view, merge_parts


class LiveView:
    """Partial sums per micro-batch on storage; reading adds them up.

    No state is held between batches, so the number of keys is not limited by
    executor memory.  A batch writes its own folder and overwrites it when it is
    run again, which keeps the sums right after a failure.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], sums: dict[str, Column]
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.sums = sums

    def _write(self, rows: DataFrame, batch: int) -> None:
        part = build_view(rows, self.keys, self.sums)
        part.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch}")

    def start(
        self, rows: DataFrame, checkpoint: str, available_now: bool = False
    ) -> StreamingQuery:
        writer = rows.writeStream.foreachBatch(self._write).option(
            "checkpointLocation", checkpoint
        )
        if available_now:
            writer = writer.trigger(availableNow=True)
        return writer.start()

    def fold(self, path: str) -> LiveView:
        """Merge the parts into a new folder, for a stream that is stopped.

        The last part keeps its batch number: if its batch was not committed, the
        restarted stream runs it again and overwrites it.
        """
        parts = self.spark.read.parquet(self.path)
        last = parts.agg(F.max("batch_id")).first()[0]
        folded = LiveView(self.spark, path, self.keys, self.sums)
        older = parts.filter(F.col("batch_id") < last)
        merge_parts(older, self.keys, list(self.sums)).write.parquet(
            f"{folded.path}/batch_id=-1"
        )
        parts.filter(F.col("batch_id") == last).drop("batch_id").write.parquet(
            f"{folded.path}/batch_id={last}"
        )
        return folded

    def read(self) -> DataFrame:
        """Current state of the view."""
        parts = self.spark.read.parquet(self.path)
        return merge_parts(parts, self.keys, list(self.sums))
