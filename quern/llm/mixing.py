"""Mixing sources to target weights, in DataFrame functions only.

1. The words of each source form one stream (documents in order of doc_id), cut into
   blocks of ``block`` words.  A document's place in the stream comes from numbers
   summed over hash buckets of the source, so no task reads a whole source.
2. The mix has as many slots as its targets need blocks, dealt over output shards.
   Each shard's source counts are a multinomial draw; the draws are made without
   replacement from the quotas of the whole mix, so that the counts of every shard
   vary like a multinomial's while those of the mix meet the targets.
3. The m-th slot of a source maps to block ``p(m mod n)`` of its n blocks, ``p`` being
   a keyed swap-or-not permutation: a bijection on any n, computed per row without a
   sort.  A source beyond its size is repeated pass by pass.
4. Slots and blocks are joined by (source, block); ``blocks`` puts the words of each
   slot together, ``mixed_documents`` those of each document.

Every draw is a function of the seed, so reruns agree.  Targets: the weights' shares
of ``ratio`` times all words, none above ``most`` times its source; the excess is
shared out again by weight until none is above.

Defined results: NULL text has no words and is never taken; the NULL source comes
last; rows that repeat a doc_id are ordered by their text's hash and each get their
words; an empty table gives an empty mix; clashing extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import materialize

BLOCK = 128
SHARD_SLOTS = 1024
_ROUNDS = 24
#: Hash buckets per source, and rows of a bucket beyond which there are more of them.
_BUCKETS = 1024
_BUCKET_ROWS = 50_000


def word_list(text: str = "text") -> Column:
    parts = F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def word_count(text: str = "text") -> Column:
    """Words without building them: the starts of runs of other characters."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: Column, ratio: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add ``target`` per source; ``sizes`` has ``source`` and ``source_size``.

    Sources are few against rows (one row each), so a window over them is small.  Each
    round caps the sources above ``most`` times their size and shares the rest again;
    the loop is one aggregate over the sorted list of caps, as the caps that bind are
    those with the smallest cap per weight.
    """
    w = Window.partitionBy(F.lit(0))
    ranked = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source"))
    upto = ranked.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        sizes.withColumn("weight", weights.cast("double"))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("all", F.sum("source_size").over(w) * F.lit(float(ratio)))
        .withColumn("total_weight", F.sum("weight").over(w))
        .withColumn("capped", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
        .withColumn("capped_weight", F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
        # The level per weight if exactly the sources before this one are capped.
        .withColumn("level", (F.col("all") - F.col("capped")) / (F.col("total_weight") - F.col("capped_weight")))
        .withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("first_free", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "source", "level"))).over(w))
        .withColumn("settled", F.col("first_free")["level"])
    )
    share = F.col("settled") * F.col("weight")
    return rows.select(
        "source", "source_size", "weight",
        F.when(F.col("settled").isNull(), F.col("cap"))
        .otherwise(F.least(share, F.col("cap"))).alias("target"),
    )


def permuted(x: Column, n: Column, key: Column) -> Column:
    """Image of ``x`` under a keyed pseudorandom permutation of 0 .. n - 1.

    Swap-or-not: in each round x is paired with (k - x) mod n, and a hash of the
    larger of both says whether the two change places.
    """

    def step(acc: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - acc, n)
        swap = F.xxhash64(key, r, F.greatest(acc, other), F.lit(1)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), x.cast("long"), step)


def streams(documents: DataFrame) -> DataFrame:
    """Documents with ``size`` (words) and ``start``, their place in the source's stream.

    Documents are dealt into hash buckets per source, as many as the number of rows
    asks for.  Buckets follow each other in the stream, and documents by doc_id inside a
    bucket.
    """
    buckets = max(_BUCKETS, -(-documents.count() // _BUCKET_ROWS))
    # Stored without texts: words are counted once, and the rows are read twice.
    rows = materialize(
        documents.select(
            "doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count().alias("size")
        ).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets))),
        "sizes",
    )
    per_bucket = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    opens = per_bucket.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"),
        F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("opens"),
    )
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "text_hash").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(opens, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .select(
            "doc_id", "source", "text_hash", "size", (F.col("opens") + F.col("inside")).alias("start")
        )
    )


def draw_slots(quotas: DataFrame, seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Slots of the mix: ``shard``, ``position``, ``source``, ``m`` (from 0 per source).

    ``quotas`` has ``source`` and ``slots``.  Slot numbers of the whole mix, source
    after source, are sent through a permutation; its image is (shard, position).  The
    counts of a shard are thus a draw without replacement from the quotas.
    """
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A number of partitions of its own: they are small until the slots are made.
    tasks = int(quotas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = (
        quotas.withColumn("from", F.coalesce(F.sum("slots").over(before), F.lit(0)))
        .withColumn("n", F.sum("slots").over(Window.partitionBy(F.lit(0))))
        .filter("slots > 0")
        # A large source is expanded in pieces, so that no task makes all its slots.
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(4096).cast("long"))))
        .repartition(tasks, "source", "piece")
        .withColumn("m", F.explode(F.sequence("piece", F.least(F.col("piece") + 4095, F.col("slots") - 1))))
    )
    image = permuted(F.col("from") + F.col("m"), F.col("n"), F.lit(seed))
    return spread.withColumn("image", image).select(
        "source", "m", (F.col("image") / shard_slots).cast("long").alias("shard"),
        (F.col("image") % shard_slots).alias("position"),
    )


def mix(
    documents: DataFrame,
    weights: Column,
    ratio: float = 1.5,
    most: float = 2.0,
    block: int = BLOCK,
    seed: int = 17,
    shard_slots: int = SHARD_SLOTS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The plan of a mix: placed documents, sources with targets, and drawn slots.

    ``weights`` may use ``place``, the source's place by code point from 0, NULL last.
    Slots have ``shard``, ``position``, ``source``, ``pass`` and ``block``.
    """
    placed = materialize(streams(documents), "streams")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    ) - 1
    goals = targets(sizes.withColumn("place", place), weights, ratio, most)
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    # The words of a source's slots: whole passes count its size, the rest whole blocks.
    passes = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    left = F.col("target") - passes * F.col("source_size")
    quotas = materialize(
        goals.withColumn("blocks", blocks).withColumn(
            "slots", (passes * blocks + F.floor(left / block + 0.5)).cast("long")
        ).withColumn("slots", F.least("slots", F.floor(F.lit(most) * blocks).cast("long"))),
        "quotas",
    )
    n = F.greatest(F.col("blocks"), F.lit(1))
    slots = (
        draw_slots(quotas.select("source", "slots"), seed, shard_slots)
        .join(quotas.select(F.col("source").alias("s"), "blocks"), F.col("source").eqNullSafe(F.col("s")))
        .select(
            "shard", "position", "source", F.floor(F.col("m") / n).alias("pass"),
            permuted(F.col("m") % n, n, F.xxhash64("source", F.lit(seed))).alias("block"),
        )
    )
    return placed, quotas, slots


def pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pieces of documents per block: ``first`` and ``words`` inside the document."""
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    begins = F.greatest(F.col("block") * block, F.col("start"))
    ends = F.least((F.col("block") + 1) * block, F.col("start") + F.col("size"))
    return (
        placed.filter("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), last)))
        .select(
            "doc_id", "text_hash", "source", "start", "block",
            (begins - F.col("start")).alias("first"), (ends - begins).alias("words"),
        )
    )


def taken_pieces(placed: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks joined by index: every piece of a document in every slot that takes it.

    Both sides are expanded from tables that may be a few KB, by which Spark would judge
    them small and send all slots, or all pieces of long texts, through the driver.
    """
    used = slots.select(
        F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none"),
        "block", "pass", "shard", "position",
    )
    parts = pieces(placed, block).withColumn("s", F.coalesce("source", F.lit(""))).withColumn(
        "none", F.col("source").isNull()
    )
    return parts.join(used.hint("merge"), ["s", "none", "block"]).drop("s", "none")


def blocks(
    documents: DataFrame, placed: DataFrame, slots: DataFrame, block: int = BLOCK
) -> DataFrame:
    """The blocks of the mix: ``shard``, ``position``, ``source``, ``pass``, ``block``, the
    ``words`` in order, and ``parts``: which document each run of words comes from.

    All blocks have ``block`` words but for the last one of a source.  Each piece of a
    document is cut from one copy of its text and travels to its slots.
    """
    texts = documents.groupBy(
        F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__hash")
    ).agg(F.any_value("text").alias("text"))
    taken = (
        taken_pieces(placed, slots, block)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.collect_list(
                F.struct("shard", "position", "source", "pass", "block", "start", "first", "words")
            ).alias("parts")
        )
    )
    own = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    cut = F.element_at(
        F.transform(
            F.array(word_list()),
            lambda words: F.transform(
                "parts",
                lambda p: F.struct(
                    p["shard"].alias("shard"), p["position"].alias("position"),
                    p["source"].alias("source"), p["pass"].alias("pass"), p["block"].alias("block"),
                    (p["start"] + p["first"]).alias("at"), p["first"].alias("first"),
                    F.slice(words, (p["first"] + 1).cast("int"), p["words"].cast("int")).alias("words"),
                ),
            ),
        ),
        1,
    )
    pieces_of = taken.join(texts, own).select("doc_id", F.inline(cut))
    slot = ["shard", "position", "source", "pass", "block"]
    in_order = F.array_sort(F.collect_list(F.struct("at", "doc_id", "first", "words")))
    return pieces_of.groupBy(*slot).agg(in_order.alias("runs")).select(
        *slot,
        F.flatten(F.col("runs.words")).alias("words"),
        F.transform(
            "runs",
            lambda r: F.struct(
                r["doc_id"].alias("doc_id"), r["first"].alias("first"),
                F.size(r["words"]).alias("words"),
            ),
        ).alias("parts"),
    )


def mixed_documents(
    documents: DataFrame, weights: Column, block: int = BLOCK, **options
) -> DataFrame:
    """The mix as documents: per document and pass, the words that the mix takes.

    All columns stay; ``text`` is unchanged where a pass takes the whole document, and
    else the taken words joined by one space; ``n_chars`` is its length.  Rows with
    equal doc_id and text each get what is taken of any of them.
    """
    placed, _, slots = mix(documents, weights, block=block, **options)
    taken = (
        taken_pieces(placed, slots, block)
        .groupBy("doc_id", "text_hash", "pass")
        .agg(F.array_sort(F.collect_set(F.struct("first", "words"))).alias("parts"))
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "parts")
    )
    # Neighbouring pieces of one document are cut from its list of words in order.  The
    # list is an element, and so a variable below: else each piece would split the text.
    cut = F.element_at(
        F.transform(
            F.array(word_list()),
            lambda words: F.flatten(
                F.transform(
                    "parts",
                    lambda p: F.slice(words, (p["first"] + 1).cast("int"), p["words"].cast("int")),
                )
            ),
        ),
        1,
    )
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    text = F.when(total == word_count(), F.col("text")).otherwise(F.array_join(cut, " "))
    own = (F.xxhash64("text") == F.col("__hash")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    kept = [F.col(c) for c in documents.columns if c not in ("text", "n_chars")]
    # Texts do not pass the driver either, however small their files are.
    mixed = documents.join(taken.hint("merge"), own).select(*kept, text.alias("text"))
    if "n_chars" in documents.columns:
        mixed = mixed.withColumn("n_chars", F.char_length("text").cast("long"))
    return mixed.select(*documents.columns)


def alternating(place: str = "place") -> Column:
    """Weights 3, 1, 2, repeating over the sources."""
    return F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)), (F.col(place) % 3 + 1).cast("int"))
