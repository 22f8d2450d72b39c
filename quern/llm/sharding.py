"""Sharding over fixed virtual slots, in DataFrame functions only.

Records are hashed into ``slots`` virtual slots, which never change.  What changes is
the slot-to-shard map: a small stored table (version, slot, shard, bytes, rows).  Version
1 deals the slots out in turn; ``rebalance`` edits the newest version into the next one,
moving only what exceeds a shard's fair share (or what a new shard needs).  ``place``
starts a map or goes on with a stored one, and stores it with all its versions.  A
record's shard is looked up through its slot in the newest version.

The map has ``slots`` rows, a fixed number, so windows over it and its broadcast are
bounded.  The law is ``bytes``: sizes of the shards are near equal.

Defined results: NULL text has no bytes, so its size is 1; a slot comes from doc_id (NULL
is a value) and the text's checksum, so rows that repeat an id or have none spread, and
only rows equal in both share a slot; texts of any length count with all their bytes;
an empty table gives an empty result with the same columns; other columns are passed
through by ``place`` unless they are named as one of its own, which replace them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.session import materialize

SLOTS = 4096


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    """A slot from the first 60 bits of the MD5 of the keys' texts."""
    texts = [F.coalesce(k.cast("string"), F.lit("null")) for k in keys]
    digest = F.md5(F.concat_ws(" ", *texts))
    return F.pmod(
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)
    ).alias("vslot")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: slots dealt out in turn."""
    return spark.range(slots).select(
        F.lit(1).alias("version"), F.col("id").alias("vslot"),
        (F.col("id") % shards).cast("int").alias("shard"),
    )


def slot_loads(sized: DataFrame) -> DataFrame:
    """Bytes and rows per slot; combined map-side to at most ``slots`` rows per task."""
    return sized.groupBy("vslot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )


def rebalance(placement: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """Edit the newest version of a map for ``shards`` shards and these loads.

    Each shard keeps its slots, largest first, while they fit into the fair share; the
    others, and the slots of shards that are gone, are dealt in order of size into the
    gaps that remain.  A slot goes to the gap in which the middle of its bytes lies.
    """
    newest = placement.agg(F.max("version")).scalar()
    current = (
        placement.filter(F.col("version") == newest)
        .select("version", "vslot", "shard")
        .join(loads, "vslot", "left")
        .select(
            "version", "vslot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
    )
    everything = Window.partitionBy(F.lit(0))
    largest_first = [F.col("bytes").desc(), F.col("vslot")]
    within = Window.partitionBy("shard").orderBy(*largest_first)
    marked = (
        current.withColumn("fair", F.sum("bytes").over(everything) / shards)
        .withColumn("upto", F.sum("bytes").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("stays", (F.col("upto") <= F.col("fair")) & (F.col("shard") < shards))
    )
    kept = marked.filter("stays").groupBy("shard").agg(F.sum("bytes").alias("used"))
    fair = marked.agg(F.max("fair")).scalar()
    ids = placement.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    gaps = (
        ids.join(kept, "shard", "left")
        .withColumn("gap", F.greatest(F.coalesce(fair, F.lit(0.0)) - F.coalesce("used", F.lit(0)), F.lit(0.0)))
        .withColumn("ends", F.sum("gap").over(before))
        .agg(F.array_sort(F.collect_list(F.struct("ends", "shard"))).alias("gaps"))
    )
    moving = Window.partitionBy(F.lit(0)).orderBy(*largest_first)
    moved = (
        marked.filter("not stays")
        .withColumn(
            "middle",
            F.sum("bytes").over(moving.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bytes") / 2,
        )
        .withColumn("gaps", gaps.scalar())
        .withColumn("open", F.filter("gaps", lambda g: g["ends"] > F.col("middle")))
        .withColumn(
            "shard",
            F.when(F.size("open") > 0, F.element_at("open", 1)["shard"]).otherwise(
                F.element_at("gaps", -1)["shard"]
            ),
        )
    )
    columns = ["vslot", "shard", "bytes", "rows"]
    return (
        marked.filter("stays").select(*columns).unionByName(moved.select(*columns))
        .withColumn("version", newest.cast("int") + 1)
    )


def number_rows(sized: DataFrame, placement: DataFrame, order: list[str]) -> DataFrame:
    """Add ``shard`` and the gapless ``slot`` of each row in its shard.

    Rows are numbered inside their virtual slot; the sizes of the slots before it in
    the shard, from the map, are added.  No task sees more than a virtual slot.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = placement.select(
        "vslot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy("vslot").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (
        sized.withColumn("__place", F.row_number().over(inside))
        .join(F.broadcast(starts), "vslot")
        .withColumn("slot", F.col("__start") + F.col("__place") - 1)
        .drop("__start", "__place")
    )


def text_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def newest_version(placement: DataFrame) -> DataFrame:
    return placement.filter(F.col("version") == placement.agg(F.max("version")).scalar())


def place(
    documents: DataFrame, shards: int = 8, slots: int = SLOTS, placement: DataFrame | None = None,
    keep: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows with ``size``, ``text_crc32``, ``vslot``, ``shard``, ``slot``; and the map.

    ``placement`` is a map of an earlier call, with the same number of slots: its newest
    version is edited for these rows and this number of shards.  The map that is returned
    is stored and has all versions.  ``keep`` names the columns that travel with a row;
    without it all do.
    """
    spark = documents.sparkSession
    own = ["size", "text_crc32", "vslot", "shard", "slot"]
    columns = documents.columns if keep is None else list(keep)
    crc = F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")))
    sized = documents.select(
        *[c for c in columns if c not in own and c != "doc_id"], "doc_id",
        text_size().alias("size"), crc.alias("text_crc32"),
        slot_of(F.col("doc_id"), crc, slots=slots),
    )
    if placement is None:
        placement = first_map(spark, shards, slots).select(
            "*", F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("rows")
        )
    # The map is stored: all lookups use one version, whatever is run again.
    edited = rebalance(placement, slot_loads(sized), shards)
    placement = materialize(placement.unionByName(edited.select(*placement.columns)), "slot-map")
    placed = number_rows(sized, newest_version(placement), ["doc_id", "size", "text_crc32"])
    first = [c for c in columns if c not in own]
    return placed.select(*first, *[c for c in ["doc_id", *own] if c not in first]), placement
