"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a
document with a smaller doc_id, or in the same document further left.  In suffix order,
the earlier positions that share most with a suffix are the previous and the next one
with a smaller position; the longer of the two common prefixes is the suffix's longest
previous factor, and the strings to remove start where it reaches ``length``.

No machine holds the suffixes of all documents.  Two equal strings of ``length`` bytes
hold the same run of 32 bytes with the smallest hash, at the same place, so every start
is sent to the bucket of that anchor and only suffixes of one bucket have to be sorted
together.  Consecutive starts with one anchor travel as one string.  Of equal
strings only the first travels on; the others are decided where they meet, in each
slice of a task and while a bucket is read.  In a bucket, strings whose anchor no other
string has drop out; the suffixes of the rest are sorted by words of eight bytes, which
also gives their common prefixes.

An anchor inside a passage of very many documents brings strings that differ at the
passage's edges into one bucket.  Where a sample of the documents puts a bucket above ``bound``
bytes, its starts are dealt by an anchor of 64 bytes, which far fewer texts share; where
even that is not enough, start by start, by a hash of the ``length`` bytes there, so that
only equal ones meet.  The sample picks the way, never the result.

Defined results: NULL text is empty; a NULL doc_id counts as larger than all others;
different rows with one doc_id are documents of their own, in order of a 64-bit hash of
their text, and rows that repeat both are one document, so they lose the same bytes;
texts are bytes of UTF-8, and what stays may cut a character; texts of any length are
worked on in pieces of 1 MB; other columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import words as W
from quern.llm.key_filter import maybe_in
from quern.llm.substring_dedup import gather, ragged
from quern.session import materialize

#: Bytes of an anchor (powers of two); buckets that are overfull go to the next level.
GRAMS = (32, 64)
GRAM = GRAMS[0]
PIECE = 1 << 20
POOL = 4 << 20
BUCKET = 8 << 20
#: One document in so many is read to find the buckets that are dealt by start.
SAMPLE = 16
_LAST = np.iinfo(np.int64).max
_PLACE = np.uint64((1 << 22) - 1)  # a place inside a piece
_REPLY = pa.schema(
    [("doc", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
)


@dataclass
class Strings:
    """Strings with their document, first byte in it, place of the anchor, and bytes."""

    doc: np.ndarray
    key: np.ndarray
    pos: np.ndarray
    anchor: np.ndarray
    sizes: np.ndarray
    data: np.ndarray

    def pack(self) -> bytes:
        n = len(self.doc)
        raw = b"".join(
            np.ascontiguousarray(a).tobytes() for a in (
                np.array([n], np.int64), np.diff(self.doc.view(np.uint64), prepend=np.uint64(0)),
                self.key, self.pos.astype(np.uint32), self.sizes.astype(np.uint32),
                self.anchor.astype(np.uint32), self.data,
            )
        )
        return zstandard.ZstdCompressor(level=3).compress(raw)

    @staticmethod
    def unpack(blob: bytes) -> Strings:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        doc = np.cumsum(np.frombuffer(raw, np.uint64, n, 8)).view(np.int64)
        key = np.frombuffer(raw, np.int64, n, 8 + 8 * n)
        pos, sizes, anchor = np.frombuffer(raw, np.uint32, 3 * n, 8 + 16 * n).reshape(3, n).astype(np.int64)
        return Strings(doc, key, pos, anchor, sizes, np.frombuffer(raw, np.uint8, offset=8 + 28 * n))

    @staticmethod
    def joined(parts: list[Strings]) -> Strings:
        return Strings(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Strings)))

    @property
    def bounds(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    def take(self, rows: np.ndarray) -> Strings:
        data = gather(self.data, self.bounds[:-1][rows], self.sizes[rows])
        return Strings(
            self.doc[rows], self.key[rows], self.pos[rows], self.anchor[rows], self.sizes[rows], data
        )

    def firsts(self) -> tuple[np.ndarray, tuple]:
        """The first entry of each distinct string, and the spans of the others."""
        codes = pa.Array.from_buffers(
            pa.large_binary(), len(self.doc),
            [None, pa.py_buffer(self.bounds), pa.py_buffer(np.ascontiguousarray(self.data))],
        ).dictionary_encode().indices.to_numpy()
        order = np.lexsort((self.pos, self.key, self.doc, codes))
        new = np.r_[True, codes[order[1:]] != codes[order[:-1]]] if len(order) else np.zeros(0, bool)
        head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        # Rows that repeat a document (and so its text) are decided by its first entry.
        other = (self.doc[head] != self.doc[order]) | (self.key[head] != self.key[order])
        gone = order[other | (self.pos[head] != self.pos[order])]
        spans = (self.doc[gone], self.key[gone], self.pos[gone], self.pos[gone] + self.sizes[gone])
        return np.sort(order[new]), spans


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) that start at each place."""
    h, width = W._BYTE[data], 1
    while width < gram:
        h = h[:-width] * W._ORDER[width.bit_length()] + h[width:]
        width *= 2
    return W.mix(h)


def least_places(hashes: np.ndarray, inside: int) -> np.ndarray:
    """Place of the smallest of ``inside`` hashes from each place on; the first of equals."""
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= inside:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < inside:
        step = inside - width
        least = np.minimum(least[:-step], least[step:])
    return (least & _PLACE).astype(np.int64)


def anchored_strings(
    data, bounds, doc, key, offset, length: int, gram: int = GRAM
) -> tuple[Strings, np.ndarray] | None:
    """Strings of rows of bytes, and the hash of each one's anchor.

    ``offset`` has the place in its document at which each row starts.
    """
    whole = np.flatnonzero(np.diff(bounds) >= length)
    if not len(whole):
        return None
    hashes = gram_hashes(data, gram)
    at = least_places(hashes, length - gram + 1)
    first = np.union1d(np.flatnonzero(at[1:] != at[:-1]) + 1, bounds[whole])
    row = np.searchsorted(bounds, first, "right") - 1
    last = np.minimum(np.r_[first[1:], len(data)] - 1, bounds[row + 1] - length)
    fits = np.flatnonzero(first <= last)
    first, last, row = first[fits], last[fits], row[fits]
    sizes = last - first + length
    pos = first - bounds[row] + offset[row]
    made = Strings(doc[row], key[row], pos, at[first] - first, sizes, gather(data, first, sizes))
    return made, hashes[at[first]]


def pieces(texts: pa.Array, length: int) -> Iterator[tuple]:
    """(first row, bytes, bounds, offset) of slices; a longer text comes in pieces, in
    which each start of a string occurs once."""
    for at, part in W.slices(texts, PIECE):
        data, bounds = W.text_bytes(part)
        if len(data) <= PIECE + length:
            yield at, data, bounds, 0
            continue
        for begin in range(0, len(data), PIECE):
            piece = data[begin : begin + PIECE + length - 1]
            yield at, piece, np.array([0, len(piece)]), begin


def _pools(batches, length: int) -> Iterator[tuple[Strings, np.ndarray]]:
    """The strings of some megabytes of text at a time."""
    for batch in batches:
        doc, key = batch.column("doc").to_numpy(), batch.column("key").to_numpy()
        held, size = [], 0
        for at, data, bounds, offset in pieces(W.text_column(batch, "text"), length):
            n = len(bounds) - 1
            begins = np.full(n, offset)
            made = anchored_strings(data, bounds, doc[at : at + n], key[at : at + n], begins, length)
            size += len(data)
            held += [made] if made else []
            if held and size >= POOL:
                yield Strings.joined([s for s, _ in held]), np.concatenate([h for _, h in held])
                held, size = [], 0
        if held:
            yield Strings.joined([s for s, _ in held]), np.concatenate([h for _, h in held])


def by_start(found: Strings, length: int) -> tuple[Strings, np.ndarray]:
    """One string for each start, and a hash of its bytes."""
    counts = found.sizes - length + 1
    string = np.repeat(np.arange(len(counts)), counts)
    step = ragged(np.zeros(len(counts), np.int64), counts)
    starts = found.bounds[:-1][string] + step
    sizes = np.full(len(starts), length)
    single = Strings(
        found.doc[string], found.key[string], found.pos[string] + step,
        found.anchor[string] - step, sizes, gather(found.data, starts, sizes),
    )
    return single, W.mix(W.running(W._BYTE[found.data], starts, starts + length))


def _rows(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def levels(length: int) -> list[int]:
    return [g for g in GRAMS if g < length]


def dealt_strings(
    found: Strings, hashes: np.ndarray, length: int, buckets: int, splits: list[np.ndarray]
) -> tuple[list[tuple[Strings, np.ndarray]], list[tuple]]:
    """The strings of each level with their buckets, and the spans that are decided.

    ``splits`` has the overfull buckets of each level; their strings go on to the next
    level, all copies of a start alike.
    """
    out, decided = [], []
    for level in range(len(splits) + 1):
        rows, gone = found.firsts()
        decided.append(gone)
        kept = found.take(rows)
        bucket = (hashes[rows] % np.uint64(buckets)).astype(np.int64)
        hot = np.isin(bucket, splits[level]) if level < len(splits) else np.zeros(len(bucket), bool)
        out.append((kept.take(np.flatnonzero(~hot)), bucket[~hot]))
        if not hot.any():
            break
        found = kept.take(np.flatnonzero(hot))
        if level + 1 < len(levels(length)):
            gram = levels(length)[level + 1]
            found, hashes = anchored_strings(
                found.data, found.bounds, found.doc, found.key, found.pos, length, gram
            )
        else:
            found, hashes = by_start(found, length)
    return out, decided


def _weigh(length: int, buckets: int, splits: list[np.ndarray]):
    """Bytes that each pool of strings brings to each bucket of the last level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, hashes in _pools(batches, length):
            out, _ = dealt_strings(found, hashes, length, buckets, splits)
            if len(out) > len(splits):
                strings, bucket = out[-1]
                number, place = np.unique(bucket, return_inverse=True)
                size = np.bincount(place, weights=strings.sizes, minlength=len(number))
                yield _rows(["bucket", "size"], number, size.astype(np.int64))
            del found, out
            W.give_back()

    return run


def overfull(
    rows: DataFrame, length: int, buckets: int, bound: int, sample: int
) -> list[np.ndarray]:
    """Per level the buckets whose strings take more than about ``bound`` bytes: at most
    what arrives there / ``bound``."""
    some = rows.filter(F.pmod(F.xxhash64("doc", "key"), F.lit(sample)) == 0)
    splits: list[np.ndarray] = []
    while len(splits) < len(levels(length)):
        sizes = some.mapInArrow(_weigh(length, buckets, splits), "bucket long, size long")
        large = sizes.groupBy("bucket").agg(F.sum("size").alias("n")).filter(F.col("n") > bound // sample)
        found = large.select("bucket").toArrow()["bucket"].to_numpy()
        if not len(found):
            break
        splits.append(found)
    return splits


def _deal(length: int, buckets: int, splits: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "decided", "packed"]
        for found, hashes in _pools(batches, length):
            parts, decided = dealt_strings(found, hashes, length, buckets, splits)
            kept = Strings.joined([s for s, _ in parts])
            bucket = np.concatenate([b for _, b in parts])
            order = np.argsort(bucket, kind="stable")
            bucket, kept = bucket[order], kept.take(order)
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            ends = kept.bounds
            out = [
                Strings(
                    *(getattr(kept, f.name)[a:b] for f in fields(Strings)[:-1]),
                    kept.data[ends[a] : ends[b]],
                ).pack()
                for a, b in zip(cuts[:-1], cuts[1:])
            ]
            yield _rows(names, bucket[cuts[:-1]], np.zeros(len(out), bool), out)
            doc, key, start, end = (np.concatenate(c) for c in zip(*decided))
            if len(doc):
                # What is decided here rides along to some bucket, another one for each pool.
                some = bucket[[int(doc[0] % len(bucket))]]
                reply = Strings(doc, key, start, np.zeros(len(doc), np.int64), end - start, np.zeros(0, np.uint8))
                yield _rows(names, some, np.ones(1, bool), [reply.pack()])
            del found, kept, out, parts
            W.give_back()

    return run


def sorted_suffixes(
    data: np.ndarray, starts: np.ndarray, group: np.ndarray, rank: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of (group, first ``length`` bytes, rank), and the number of
    bytes, up to ``length``, that each shares with the one before it in its group."""
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    order = np.lexsort((rank, group))
    new = np.r_[True, group[order[1:]] != group[order[:-1]]]
    common = np.where(new, 0, length)
    for offset in [*range(0, length - 8, 8), length - 8]:
        tied = ~new
        tied[:-1] |= ~new[1:]
        active = np.flatnonzero(tied)  # places in the order that are not alone yet
        if not len(active):
            break
        part = np.cumsum(new)[active]
        mine = order[active]
        word = words[starts[mine] + offset].astype(np.uint64)
        by = np.lexsort((word, part))  # stable: ranks stay in order
        order[active], word = mine[by], word[by]
        differ = np.flatnonzero((part[1:] == part[:-1]) & (word[1:] != word[:-1]))
        apart = word[differ] ^ word[differ + 1]
        same = sum((apart < np.uint64(1 << b)).astype(np.int64) for b in range(8, 64, 8))
        common[active[differ + 1]] = offset + same
        new[active[differ + 1]] = True
    return order, common


def previous_factors(rank: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """Longest previous factors of suffixes in suffix order, as far as they reach
    ``length``: the larger common prefix with the previous and the next smaller rank.

    ``common`` is the prefix that each suffix shares with the one before it.
    """
    factor = np.zeros(len(rank), np.int64)
    for back in (False, True):
        r = rank[::-1] if back else rank
        share = np.r_[0, common[:0:-1]] if back else common.copy()
        near = np.arange(len(r)) - 1
        while True:
            go = np.flatnonzero((share >= length) & (r[near] >= r))
            if not len(go):
                break
            # Everything between a place and its `near` has no smaller rank: skip it.
            hop = near[go]
            share[go], near[go] = np.minimum(share[go], share[hop]), near[hop]
        share = np.where((share >= length) & (r[near] >= r), 0, share)
        factor = np.maximum(factor, share[::-1] if back else share)
    return factor


def settle(found: Strings, length: int) -> tuple:
    """Spans of repeated bytes of a bucket; its strings are distinct."""
    bounds = found.bounds[:-1]
    data = np.concatenate([found.data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    gram = np.zeros(len(bounds), np.uint64)
    for i in range(0, GRAM, 8):
        gram = W.mix(gram + words[bounds + found.anchor + i].astype(np.uint64) * W._ORDER[i])
    _, code, times = np.unique(gram, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times[code] > 1)
    counts = found.sizes[shared] - length + 1
    string = np.repeat(shared, counts)
    step = ragged(np.zeros(len(shared), np.int64), counts)
    # Equal strings have their anchors at equal places: other suffixes need not meet.
    place = found.anchor[string] - step
    group = code[string] * (length + 1) + place
    _, group, times = np.unique(group, return_inverse=True, return_counts=True)
    meets = np.flatnonzero(times[group] > 1)
    string, step, group = string[meets], step[meets], group[meets]
    if not len(string):
        return tuple(np.zeros((4, 0), np.int64))
    at = np.lexsort((found.pos[string] + step, found.key[string], found.doc[string]))
    rank = np.empty(len(at), np.int64)
    rank[at] = np.arange(len(at))
    order, common = sorted_suffixes(found.data, bounds[string] + step, group, rank, length)
    factor = previous_factors(rank[order], common, length)
    hit = np.sort(order[factor >= length])
    if not len(hit):
        return tuple(np.zeros((4, 0), np.int64))
    s, p = string[hit], step[hit]
    new = np.r_[True, (s[1:] != s[:-1]) | (p[1:] != p[:-1] + 1)]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(hit) - 1]
    e = s[new]
    return found.doc[e], found.key[e], found.pos[e] + p[new], found.pos[e] + p[last] + length


def _judge(length: int):
    """Settle each bucket; rows come in order of bucket."""

    def reply(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_REPLY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Strings] = []
        size, compact, current = 0, 2 * BUCKET, None

        def combine() -> tuple[Strings, pa.RecordBatch]:
            rows, gone = (joined := Strings.joined(held)).firsts()
            held.clear()
            return joined.take(rows), reply(gone)

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                found, gone = combine()
                yield gone
                yield reply(settle(found, length))
                del found
                W.give_back()

        for batch in batches:
            for bucket, decided, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bucket != current:
                    yield from close()
                    size, compact, current = 0, 2 * BUCKET, bucket
                part = Strings.unpack(packed)
                if decided:
                    yield reply((part.doc, part.key, part.pos, part.pos + part.sizes))
                    continue
                held.append(part)
                size += len(part.data)
                if size > compact:
                    found, gone = combine()
                    yield gone
                    held.append(found)
                    size = len(found.data)
                    compact = 2 * max(size, BUCKET)
        yield from close()

    return run


def keyed(documents: DataFrame) -> DataFrame:
    """Rows with ``doc``, their order, and ``key``, which tells rows of one doc_id apart.

    It is a hash of the text, or 0 where no other row has the doc_id: zeros take no space.
    """
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), doc.alias("doc"), "text")
    repeated = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc")
    marked = maybe_in(rows, materialize(repeated, "repeated-ids"), ["doc"], "__repeated")
    key = F.when(F.col("__repeated"), F.xxhash64("text")).otherwise(F.lit(0))
    return marked.select("doc_id", "doc", key.alias("key"), "text")


def repeated_bytes(
    rows: DataFrame, length: int = 100, buckets: int | None = None,
    bound: int = 4 * BUCKET, sample: int = SAMPLE,
) -> DataFrame:
    """``doc``, ``key`` and the byte span [start, end) of repeated strings of ``keyed``
    rows; they may overlap."""
    if length <= GRAM:
        raise ValueError(f"length has to be above {GRAM}")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if buckets is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(tasks, 4 * size // BUCKET)
    splits = overfull(rows, length, buckets, bound, sample)
    return (
        rows.mapInArrow(_deal(length, buckets, splits), "bucket long, decided boolean, packed binary")
        .repartition(max(tasks, min(buckets, 20_000)), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_judge(length), "doc long, key long, start long, end long")
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut spans out of the bytes of each text, a slice at a time."""
    for batch in batches:
        texts, ids, lists = W.text_column(batch, "text"), batch.column("doc_id"), batch.column("spans")
        for at, part in W.slices(texts, POOL):
            data, bounds = W.text_bytes(part)
            spans = lists.slice(at, len(part))
            row = np.repeat(np.arange(len(part)), spans.value_lengths().fill_null(0).to_numpy())
            start, end = (spans.flatten().field(i).to_numpy() for i in (0, 1))
            depth = np.zeros(len(data) + 1, np.int32)
            np.add.at(depth, bounds[row] + start, 1)
            np.add.at(depth, bounds[row] + end, -1)
            gone = np.cumsum(depth[:-1]) > 0
            before = np.concatenate([[0], np.cumsum(gone)])
            removed = before[bounds[1:]] - before[bounds[:-1]]
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            filled = bounds[:-1][np.diff(bounds) > 0]
            opens[filled] = gone[filled]  # a run ends with its text
            runs = np.concatenate([[0], np.cumsum(opens)])
            kept = np.ascontiguousarray(data[~gone])
            offsets = np.concatenate([[0], np.cumsum(np.diff(bounds) - removed)])
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, len(part)), pa.array(np.diff(bounds)), pa.array(removed),
                    pa.array(runs[bounds[1:]] - runs[bounds[:-1]]),
                    pa.Array.from_buffers(
                        pa.large_binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
                    ).cast(pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )
            W.give_back()


def without_repeated_bytes(documents: DataFrame, length: int = 100, **limits) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes of every row."""
    span = F.struct("start", "end")
    keys = keyed(documents)
    spans = materialize(
        repeated_bytes(keys, length, **limits)
        .groupBy("doc", "key").agg(F.collect_set(span).alias("spans")),
        "byte-spans",
    )
    rows = maybe_in(keys, spans, ["doc", "key"], "__cut")
    # Only texts that may lose bytes travel to meet their spans.
    cut = rows.filter("__cut").join(spans.hint("shuffle_hash"), ["doc", "key"], "left")
    whole = rows.filter("not __cut").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    columns = ["doc_id", "text", "spans"]
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return cut.select(*columns).mapInArrow(_cut, out).unionByName(
        whole.select(*columns).mapInArrow(_cut, out)
    )
