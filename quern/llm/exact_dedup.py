"""Exact duplicates by an extendible-hash index on shared files.

1. Pages.  Tasks read documents in slices, bring texts to normal form (A-Z lowered),
   merge the copies inside a slice and write one entry per distinct text (hash, digest,
   text, row ids) to the shared folder.
2. Distinct texts.  Entries of one hash and digest are combined map-side, without their
   text, so a text that a third of all rows share is one row per task.
3. Directory.  Sizes are summed per hash prefix.  Starting from one bucket, every
   overfull bucket is split by its next hash bit; when its depth passes the
   directory's, the directory doubles.  It has at most 2 ** ``bits`` slots, which
   bounds what the driver holds, and is stored next to the pages.
4. Owners.  Each task owns key ranges of neighbouring buckets.  It reads distinct texts
   in order of hash, chains those whose hashes collide, and compares their bytes, so
   only identical texts form a group.

``ExactIndex`` keeps the distinct texts of many batches: a batch is looked up, and
inserted by writing its own texts only, after which overfull buckets are split further.

Defined results: NULL counts as empty; the row with the largest doc_id stays, NULL
being the smallest, and of rows with equal doc_id and text the first entry; texts of any
length are compared whole; columns besides ``doc_id`` and ``text`` are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import words as W
from quern.llm.key_filter import maybe_in
from quern.session import materialize
from quern.sources.versions import read_file, replace_file

SLICE = 4 << 20
#: A text with fewer entries is never treated as frequent.
LEAST_HOT = 1000
_ENTRY = pa.schema(
    [
        ("hash", pa.int64()), ("text", pa.string()), ("size", pa.int64()),
        ("text_sha256", pa.string()), ("ids", pa.list_(pa.int64())),
    ]
)


def hash_text(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = W.text_column(batch, "text")
        ids = batch.column("doc_id")
        for at, part in W.slices(texts, SLICE):
            data, bounds = W.text_bytes(part)
            data = W.lower_ascii(data)
            normal = pa.Array.from_buffers(
                pa.large_string(), len(part),
                [None, pa.py_buffer(np.ascontiguousarray(bounds)), pa.py_buffer(data)],
            ).dictionary_encode()
            codes = normal.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            cuts = np.concatenate([[0], np.cumsum(np.bincount(codes))]).astype(np.int32)
            raw = [x.encode() for x in normal.dictionary.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hash_text(x) for x in raw], pa.int64()),
                    normal.dictionary.cast(pa.string()),
                    pa.array([len(x) + 64 for x in raw], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                    pa.ListArray.from_arrays(pa.array(cuts), ids.slice(at, len(part)).take(pa.array(order))),
                ],
                schema=_ENTRY,
            )


def grow_directory(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int, list[tuple[int, int]]]:
    """Split overfull buckets until none is, or no bit is left.

    ``sizes`` has the bytes per hash prefix, for all prefixes of ``bits`` bits.
    Returns the directory (bucket number per slot), its depth, and each bucket's
    (local depth, prefix), in order of key.
    """
    bits = max(len(sizes).bit_length() - 1, 0)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    directory, depth = [(0, 0)], 0
    waiting = [(0, 0)]
    while waiting:
        local, prefix = waiting.pop()
        width = 1 << (bits - local)
        load = sums[(prefix + 1) * width] - sums[prefix * width]
        if load <= capacity or local == bits:
            continue
        if local == depth:
            directory = [slot for slot in directory for _ in (0, 1)]
            depth += 1
        share = 1 << (depth - local - 1)
        first = (2 * prefix) * share
        low, high = (local + 1, 2 * prefix), (local + 1, 2 * prefix + 1)
        directory[first : first + share] = [low] * share
        directory[first + share : first + 2 * share] = [high] * share
        waiting += [low, high]
    buckets = list(dict.fromkeys(directory))
    number = {bucket: i for i, bucket in enumerate(buckets)}
    return np.array([number[slot] for slot in directory]), depth, buckets


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries come in order of hash; equal texts of one hash form a group."""
    current, chain = None, {}

    def settle() -> Iterator[pa.RecordBatch]:
        rows = []
        for members in chain.values():
            size = sum(n for _, _, n in members)
            keep_id, holder = max(
                ((i is not None, i or 0), -entry) for entry, i, _ in members
            )
            keep = keep_id[1] if keep_id[0] else None
            rows += [(entry, keep, size, entry == -holder) for entry, _, _ in members]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column, kind)
                    for column, kind in zip(
                        zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                    )
                ],
                names=["entry", "keep_id", "group_size", "holds"],
            )

    done = 0
    ready: list[pa.RecordBatch] = []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("hash", "text", "entry", "top", "n"))
        for h, text, entry, top, n in zip(*columns):
            if h != current:
                ready += settle()
                done += 1
                current, chain = h, {}
                if done % 4096 == 0 and ready:
                    yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                    ready = []
            # A dictionary compares the bytes of the texts in the chain.
            chain.setdefault(text, []).append((entry, top, n))
    ready += settle()
    if ready:
        yield from pa.Table.from_batches(ready).combine_chunks().to_batches()


def _slot(bits: int):
    """The first ``bits`` bits of the hash, as a number."""
    return F.shiftright(F.col("hash"), 64 - bits) + (1 << (bits - 1))


def slot_sizes(distinct: DataFrame, bits: int) -> np.ndarray:
    """Bytes of distinct texts per hash prefix."""
    loads = distinct.groupBy(_slot(bits).alias("slot")).agg(F.sum("size").alias("size")).toArrow()
    sizes = np.zeros(1 << bits, dtype=np.int64)
    sizes[loads["slot"].to_numpy()] = loads["size"].to_numpy()
    return sizes


def directory_table(
    spark: SparkSession, sizes: np.ndarray, capacity: int, owners: int
) -> DataFrame:
    """The stored directory: ``slot``, ``bucket``, ``owner`` for each hash prefix."""
    bits = len(sizes).bit_length() - 1
    capacity = max(capacity, int(sizes.sum()) >> bits)
    directory, depth, _ = grow_directory(sizes, capacity)
    bucket = np.repeat(directory, 1 << (bits - depth))
    load = np.bincount(bucket, weights=sizes)
    before = np.concatenate([[0], np.cumsum(load)[:-1]])
    owner = (before * owners // max(load.sum(), 1)).astype(np.int64)
    # Slots of one bucket are neighbours: a range per bucket is enough to store it.
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    last = np.r_[first[1:], len(bucket)] - 1
    rows = [
        (int(a), int(b), int(bucket[a]), int(owner[bucket[a]])) for a, b in zip(first, last)
    ]
    ranges = spark.createDataFrame(rows, "first long, last long, bucket long, owner long")
    return materialize(
        ranges.select(F.explode(F.sequence("first", "last")).alias("slot"), "bucket", "owner"),
        "directory",
    )


def page_entries(documents: DataFrame) -> DataFrame:
    """The stored pages of a batch."""
    return materialize(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(_pages, "hash long, text string, size long, text_sha256 string, ids array<long>")
        .withColumn("entry", F.monotonically_increasing_id()),
        "pages",
    )


def distinct_entries(entries: DataFrame) -> DataFrame:
    """One row per hash and digest, without text: rows, entries, and who is kept."""
    top = F.array_max("ids")
    kept = F.struct(
        top.isNotNull().alias("known"), F.coalesce(top, F.lit(0)).alias("id"), (-F.col("entry")).alias("entry")
    )
    return entries.groupBy("hash", "text_sha256").agg(
        F.min("entry").alias("entry"), F.max("size").alias("size"),
        F.sum(F.size("ids").cast("long")).alias("n"), F.count(F.lit(1)).alias("entries"),
        F.max(kept).alias("kept"),
    ).select(
        "hash", "text_sha256", "entry", "size", "n", "entries",
        F.when(F.col("kept.known"), F.col("kept.id")).alias("top"),
        (-F.col("kept.entry")).alias("holder"),
    )


def owned_groups(
    texts: DataFrame, directory: DataFrame, bits: int, owners: int
) -> DataFrame:
    """Groups of equal texts: ``entry``, ``keep_id``, ``group_size``; ``texts`` has one row
    per hash and digest with ``text``, ``entry``, ``top`` and ``n``."""
    return (
        texts.withColumn("slot", _slot(bits))
        .join(F.broadcast(directory), "slot")  # 2 ** bits rows of 24 bytes at most
        .repartition(owners, "owner")
        .sortWithinPartitions("bucket", "hash")
        .select("hash", "text", "entry", "top", "n")
        .mapInArrow(_own, "entry long, keep_id long, group_size long, holds boolean")
        .drop("holds")
    )


def _with_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct texts from rows in order of hash and digest, in which the counts of a text
    come before the text itself; texts of other entries are passed over."""
    names = ["hash", "text_sha256", "text", "entry", "top", "n"]
    counts = None
    for batch in batches:
        rows = []
        for h, digest, text, entry, top, n in zip(*(batch.column(c).to_pylist() for c in names)):
            if n is not None:
                counts = (h, digest, entry, top, n)
            elif counts is not None and counts[:3] == (h, digest, entry):
                rows.append((h, text, entry, *counts[3:]))
        columns = zip(*rows) if rows else [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["hash", "text", "entry", "top", "n"]
        )


def settled_groups(
    entries: DataFrame, distinct: DataFrame, directory: DataFrame, bits: int, owners: int
) -> DataFrame:
    """Like ``owned_groups``, for the pages of a batch: counts and texts travel to their
    owner side by side.  A filter of fixed size keeps back texts of entries that do not
    stand for their group, so a frequent text travels about once."""
    none = F.lit(None).cast("long")
    texts = maybe_in(
        entries.select("hash", "text_sha256", "text", "entry"), distinct, ["entry"], "stands"
    ).filter("stands").select("hash", "text_sha256", "text", "entry", none.alias("top"), none.alias("n"))
    counts = distinct.select(
        "hash", "text_sha256", F.lit(None).cast("string").alias("text"), "entry", "top", "n"
    )
    found = (
        texts.unionByName(counts).withColumn("slot", _slot(bits))
        .join(F.broadcast(directory), "slot")  # 2 ** bits rows of 24 bytes at most
        .repartition(owners, "owner")
        .sortWithinPartitions("bucket", "hash", "text_sha256", F.col("n").isNull())
        .select("hash", "text_sha256", "text", "entry", "top", "n")
        .mapInArrow(_with_texts, "hash long, text string, entry long, top long, n long")
    )
    return found.mapInArrow(_own, "entry long, keep_id long, group_size long, holds boolean").drop("holds")


def _per_entry(entries: DataFrame, groups: DataFrame, columns: list[str]) -> DataFrame:
    """Entries next to their group by hash and digest.

    A group with more entries than an even share per task is looked up in a broadcast;
    there are at most as many such groups as tasks.
    """
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = max(LEAST_HOT, (groups.agg(F.sum("entries")).first()[0] or 0) // tasks)
    keys = ["hash", "text_sha256"]
    own = F.struct(*columns)
    many = groups.filter(F.col("entries") > hot).select(*keys, own.alias("many"))
    few = groups.filter(F.col("entries") <= hot).select(*keys, own.alias("few"))
    marked = entries.join(F.broadcast(many), keys, "left")
    rest = marked.filter("many IS NULL").drop("many").join(few, keys)
    same = marked.filter("many IS NOT NULL").withColumnRenamed("many", "few")
    found = rest.unionByName(same)
    return found.select(*entries.columns, *[f"few.{c}" for c in columns])


def exact_groups(
    documents: DataFrame, bits: int = 16, capacity: int = 16 << 20, owners: int | None = None
) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of every row."""
    spark = documents.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = page_entries(documents)
    distinct = materialize(distinct_entries(entries), "distinct-texts")
    directory = directory_table(spark, slot_sizes(distinct, bits), capacity, owners)
    settled = settled_groups(entries, distinct, directory, bits, owners)
    groups = materialize(
        distinct.select("hash", "text_sha256", "entry", "entries", "holder").join(settled, "entry"),
        "groups",
    )
    found = _per_entry(
        entries.select("hash", "text_sha256", F.col("entry").alias("page"), "ids"), groups,
        ["keep_id", "group_size", "holder"],
    )
    first = F.when(
        F.col("keep_id").isNull(), F.lit(1).cast("long")
    ).otherwise(F.array_position("ids", F.col("keep_id")))
    holds = F.col("page") == F.col("holder")
    return (
        found.withColumn("first", first)
        .select("keep_id", "group_size", holds.alias("holds"), "first", "text_sha256", F.posexplode("ids").alias("at", "doc_id"))
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("holds") & (F.col("at") + 1 == F.col("first"))).alias("kept"), "text_sha256",
        )
    )


class ExactIndex:
    """An index of texts that batches of documents are looked up in and inserted into.

    Each batch adds one folder with its distinct texts; a text of several batches has a
    row in each.  The directory is stored anew after a batch, with the buckets that
    became overfull split further; which folders and directory count is switched in one
    step, so a batch that dies leaves the index as it was.
    """

    def __init__(self, spark: SparkSession, root: str, bits: int = 16, capacity: int = 16 << 20):
        self.spark = spark
        self.bits = bits
        self.capacity = capacity
        self.root = root.rstrip("/")

    def _state(self) -> dict:
        text = read_file(self.spark, f"{self.root}/_index.json")
        return json.loads(text) if text else {"texts": [], "directory": None}

    def directory(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self._state()['directory']}")

    def _texts(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders])

    def insert(self, documents: DataFrame) -> None:
        """Add a batch; reads the batch, and sizes per hash prefix of the index."""
        entries = page_entries(documents)
        distinct = entries.select("entry", "text").join(distinct_entries(entries), "entry")
        name = f"texts-{uuid.uuid4().hex}"
        distinct.select("hash", "text_sha256", "text", "size", "n", "top").write.parquet(
            f"{self.root}/{name}"
        )
        folders = [*self._state()["texts"], name]
        owners = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        sizes = slot_sizes(self._texts(folders), self.bits)
        directory = f"directory-{uuid.uuid4().hex}"
        directory_table(self.spark, sizes, self.capacity, owners).write.parquet(
            f"{self.root}/{directory}"
        )
        state = {"texts": folders, "directory": directory}
        replace_file(self.spark, f"{self.root}/_index.json", json.dumps(state))

    def lookup(self, documents: DataFrame) -> DataFrame:
        """``doc_id`` of every row, and ``keep_id`` and ``group_size`` of its text in the
        index; size 0 where the index does not have the text."""
        entries = page_entries(documents)
        state = self._state()
        distinct = entries.select("entry", "text").join(distinct_entries(entries), "entry")
        asked = distinct.select("hash", "text", "entry", F.lit(None).cast("long").alias("top"), F.lit(0).cast("long").alias("n"))
        if state["texts"]:
            held = self._texts(state["texts"]).select(
                "hash", "text", F.lit(-1).cast("long").alias("entry"), "top", "n"
            )
            owners = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            # Only held texts of hashes that were asked for travel to their owners.
            held = held.join(asked.select("hash").distinct(), "hash", "left_semi")
            answers = owned_groups(
                asked.unionByName(held), self.directory(), self.bits, owners
            ).filter("entry >= 0")
        else:
            answers = asked.select("entry", F.col("top").alias("keep_id"), F.col("n").alias("group_size"))
        groups = materialize(
            distinct.select("hash", "text_sha256", "entry", "entries").join(answers, "entry"), "answers"
        )
        found = _per_entry(entries.select("hash", "text_sha256", "ids"), groups, ["keep_id", "group_size"])
        return found.select(F.explode("ids").alias("doc_id"), "keep_id", "group_size")
