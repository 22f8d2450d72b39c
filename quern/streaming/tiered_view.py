"""A grouped aggregate that merges its own parts while its stream runs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quern.operators.maintained import build_view, merge_parts
from quern.sources.versions import child_folders, read_file, remove, replace_file

_POINTER = "_parts.json"


class TieredView:
    """Partial sums per micro-batch, merged in tiers; reading adds up what is left.

    A batch writes one part of tier 0.  ``fan`` parts of a tier are merged into one of
    the next, so after n batches there are at most ``fan - 1`` parts for each of
    log(n) tiers, and a part is rewritten once per tier.  A pointer file names the parts
    that count and the last batch in them, and is replaced in one rename after all parts
    of a batch are written.  If the stream dies before, the parts it wrote are not
    named; the batch runs again and writes others.  A batch that the pointer already
    holds is not added again.  No state is kept between batches.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], sums: dict[str, Column],
        fan: int = 8,
    ):
        if fan < 2:
            raise ValueError("a tier needs at least two parts")
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.sums = sums
        self.fan = fan

    def state(self) -> dict:
        """Last batch, and the parts of each tier."""
        text = read_file(self.spark, f"{self.path}/{_POINTER}")
        return json.loads(text) if text else {"last": -1, "tiers": []}

    def _store(self, part: DataFrame) -> str:
        name = f"part-{uuid.uuid4().hex}"
        part.write.parquet(f"{self.path}/{name}")
        return name

    def _open(self, names: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{n}" for n in names])

    def _point(self, state: dict) -> None:
        replace_file(self.spark, f"{self.path}/{_POINTER}", json.dumps(state))

    def add(self, rows: DataFrame, batch: int) -> None:
        """Add a micro-batch; batches come in ascending order and may come again."""
        state = self.state()
        if batch <= state["last"]:
            return
        tiers = [list(t) for t in state["tiers"]] or [[]]
        tiers[0].append(self._store(build_view(rows, self.keys, self.sums)))
        gone = []
        for level in range(len(tiers)):
            if len(tiers[level]) < self.fan:
                break
            merged = merge_parts(self._open(tiers[level]), self.keys, list(self.sums))
            if level + 1 == len(tiers):
                tiers.append([])
            tiers[level + 1].append(self._store(merged))
            gone += tiers[level]
            tiers[level] = []
        before = {n for t in state["tiers"] for n in t}
        # Parts that the last pointer names may still be read; older ones are not.
        self._point({"last": batch, "tiers": tiers, "gone": [n for n in gone if n in before]})
        for name in [*state.get("gone", []), *(n for n in gone if n not in before)]:
            remove(self.spark, f"{self.path}/{name}")

    def start(
        self, rows: DataFrame, checkpoint: str, available_now: bool = False
    ) -> StreamingQuery:
        writer = rows.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint)
        if available_now:
            writer = writer.trigger(availableNow=True)
        return writer.start()

    def parts(self) -> list[str]:
        return [n for tier in self.state()["tiers"] for n in tier]

    def sweep(self) -> list[str]:
        """Delete parts that nothing names, left by a stream that died; for a stopped one."""
        state = self.state()
        named = {n for t in state["tiers"] for n in t}
        lost = [
            n for n in child_folders(self.spark, self.path)
            if n.startswith("part-") and n not in named
        ]
        for name in lost:
            remove(self.spark, f"{self.path}/{name}")
        return lost

    def read(self) -> DataFrame:
        """Current state of the view; before the first batch there is none."""
        names = self.parts()
        if not names:
            raise ValueError(f"{self.path} has no part yet")
        return merge_parts(self._open(names), self.keys, list(self.sums))
