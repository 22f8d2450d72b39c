"""Tables whose new version replaces the old one in a single step.

A version is a set of folders; a small pointer file names those that count.  New data
goes into a fresh folder, then the pointer is replaced by one rename, so a reader sees
the old version or the new one, a write that dies leaves the old one readable, and a
DataFrame that was opened keeps its version.  Folders stay until ``forget`` removes
them.  Of two writers at once the last to rename wins; there is no log and no lock.  The
rename has to be atomic, as on HDFS and on mounted disks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.operators.layout import (
    TARGET_BYTES,
    layout_report,
    target_pieces,
    unsorted_files,
)

_POINTER = "_current.json"


def _hadoop(spark: SparkSession, path: str):
    """File context, and path object, of a path."""
    jvm = spark._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.Path(path)
    return jvm, conf, target, target.getFileSystem(conf)


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see its old content or the new one."""
    jvm, conf, target, fs = _hadoop(spark, path)
    draft = jvm.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    overwrite[0] = jvm.Options.Rename.OVERWRITE
    context = jvm.FileContext.getFileContext(fs.makeQualified(target).toUri(), conf)
    context.rename(fs.makeQualified(draft), fs.makeQualified(target), overwrite)


def read_file(spark: SparkSession, path: str) -> str | None:
    _, _, target, fs = _hadoop(spark, path)
    if not fs.exists(target):
        return None
    source = fs.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    _, _, target, fs = _hadoop(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder, after making the folder that it moves into."""
    jvm, _, source, fs = _hadoop(spark, path)
    fs.mkdirs(jvm.Path(target).getParent())
    if not fs.rename(source, jvm.Path(target)):
        raise OSError(f"cannot move {path} to {target}")


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, such as those of partition values."""
    _, _, target, fs = _hadoop(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


class VersionedTable:
    """A parquet table of versions below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _state(self) -> dict:
        text = read_file(self.spark, f"{self.root}/{_POINTER}")
        return json.loads(text) if text else {"versions": []}

    def _switch(self, state: dict, folders: list[str], schema: str, partition: str | None) -> int:
        number = state["versions"][-1]["version"] + 1 if state["versions"] else 1
        entry = {"version": number, "folders": folders, "schema": schema, "partition": partition}
        state = {"versions": [*state["versions"], entry]}
        replace_file(self.spark, f"{self.root}/{_POINTER}", json.dumps(state))
        return number

    def versions(self) -> list[int]:
        return [v["version"] for v in self._state()["versions"]]

    def _write(self, df: DataFrame, partition: str | None) -> list[str]:
        """Write a fresh folder, or one in the folder of each partition value."""
        fresh = f"v-{uuid.uuid4().hex}"
        writer = df.write.mode("errorifexists")
        if partition is None:
            writer.parquet(f"{self.root}/{fresh}")
            return [fresh]
        writer.partitionBy(partition).parquet(f"{self.root}/{fresh}")
        names = [n for n in child_folders(self.spark, f"{self.root}/{fresh}") if "=" in n]
        for name in names:
            move(self.spark, f"{self.root}/{fresh}/{name}", f"{self.root}/{name}/{fresh}")
        remove(self.spark, f"{self.root}/{fresh}")
        return [f"{name}/{fresh}" for name in names]

    def publish(self, df: DataFrame, partition: str | None = None) -> int:
        """Write a new version and make it the current one; returns its number."""
        folders = self._write(df, partition)
        return self._switch(self._state(), folders, df.schema.json(), partition)

    def _open(self, entry: dict) -> DataFrame:
        schema = StructType.fromJson(json.loads(entry["schema"]))
        if not entry["folders"]:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.root)
        return reader.parquet(*[f"{self.root}/{f}" for f in entry["folders"]])

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or one that has not been forgotten."""
        found = [v for v in self._state()["versions"] if version in (None, v["version"])]
        if not found:
            raise ValueError(f"{self.root} has no version {version or ''}".rstrip())
        schema = StructType.fromJson(json.loads(found[-1]["schema"]))
        return self._open(found[-1]).select(*schema.names)

    def compact(self, target_bytes: int = TARGET_BYTES) -> list:
        """Rewrite the partitions that the layout report lists, as a new version.

        The other partitions keep their folders: they are neither read nor written.
        Returns the partition values that were rewritten.
        """
        state = self._state()
        entry = state["versions"][-1]
        partition = entry["partition"]
        if partition is None:
            raise ValueError("only a partitioned table can be compacted by partition")
        if not entry["folders"]:
            return []
        stored = self._open(entry)
        report = layout_report(stored, partition, target_bytes)
        todo = report.filter(F.col("action") != "keep").select(partition, "total_bytes")
        listed = todo.collect()  # one row per partition folder
        if not listed:
            return []
        pieces = target_pieces(stored, partition, listed, todo.schema, target_bytes)
        with unsorted_files(self.spark):
            fresh = self._write(pieces, partition)
        names = {f.split("/")[0] for f in fresh}
        old = [f for f in entry["folders"] if f.split("/")[0] not in names]
        self._switch(state, old + fresh, entry["schema"], partition)
        return [row[partition] for row in listed]

    def forget(self, keep: int = 1) -> None:
        """Drop all but the newest ``keep`` versions, then the folders only they used."""
        state = self._state()
        kept = state["versions"][-keep:]
        replace_file(self.spark, f"{self.root}/{_POINTER}", json.dumps({"versions": kept}))
        used = {f for v in kept for f in v["folders"]}
        for folder in child_folders(self.spark, self.root):
            inside = child_folders(self.spark, f"{self.root}/{folder}") if "=" in folder else []
            for found in [f"{folder}/{n}" for n in inside] or [folder]:
                if found.split("/")[-1].startswith("v-") and found not in used:
                    remove(self.spark, f"{self.root}/{found}")
