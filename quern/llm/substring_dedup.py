"""Removal of repeated word windows by super-k-mer partitioning.

A window is ``window`` consecutive words of one document.  Its minimiser is the run
of ``gram`` words inside it with the smallest hash; consecutive windows that share
the occurrence of their minimiser travel as one packed string (words joined by one
space) to the bucket of that minimiser.  Equal windows have equal minimisers, so each
window is counted whole in one bucket: there, windows are sorted by hash, equal
hashes are compared byte by byte, and the smallest document of each is found.

Of equal packed strings only those of the smallest document travel on: the windows
of the others are decided on the spot.  This happens in every slice of a task and
again while a bucket is read, so a passage in a third of all documents reaches its
bucket once per slice and takes the space of one string there.

Strings at the edges of a shared passage hold neighbouring words of their document, so
they differ, and a frequent minimiser would fill one bucket.  Buckets that a sample of
the documents puts above ``bound`` bytes are dealt window by window instead, by a hash
of all words of the window: then only equal windows meet.  The sample picks the way,
never the result.

Defined results: NULL text has no words; a NULL doc_id counts as larger than all
others; rows that repeat a doc_id do not remove each other's words; columns besides
``doc_id`` and ``text`` are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import words as W
from quern.llm.key_filter import maybe_in
from quern.session import materialize

SLICE = 3 << 20
BUCKET = 8 << 20
#: One document in so many is read to find the buckets that are dealt by window.
SAMPLE = 16
CHUNK = 1 << 19
LEVEL = 3
_LAST = np.iinfo(np.int64).max
_REPLY = pa.schema(
    [("doc", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
)


class Strings:
    """Packed strings with the document, row key and first word of each."""

    def __init__(self, doc, key, pos, sizes, data):
        self.doc, self.key, self.pos, self.sizes, self.data = doc, key, pos, sizes, data

    def pack(self) -> bytes:
        """Compressed; documents are stored by differences, as most are in order."""
        steps = np.diff(self.doc.view(np.uint64), prepend=np.uint64(0))
        parts = [
            np.array([len(self.doc)], np.int64), steps, self.key,
            self.pos.astype(np.uint32), self.sizes.astype(np.uint32), self.data,
        ]
        raw = b"".join(np.ascontiguousarray(p).tobytes() for p in parts)
        return zstandard.ZstdCompressor(level=LEVEL).compress(raw)

    @staticmethod
    def unpack(blob: bytes) -> Strings:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        doc = np.cumsum(np.frombuffer(raw, np.uint64, n, 8)).view(np.int64)
        key = np.frombuffer(raw, np.int64, n, 8 + 8 * n)
        pos, sizes = np.frombuffer(raw, np.uint32, 2 * n, 8 + 16 * n).reshape(2, n).astype(np.int64)
        return Strings(doc, key, pos, sizes, np.frombuffer(raw, np.uint8, offset=8 + 24 * n))

    @staticmethod
    def joined(parts: list[Strings]) -> Strings:
        names = ("doc", "key", "pos", "sizes", "data")
        return Strings(*(np.concatenate([getattr(p, n) for p in parts]) for n in names))

    @property
    def bounds(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    def take(self, rows: np.ndarray) -> Strings:
        bounds = self.bounds
        data = gather(self.data, bounds[:-1][rows], self.sizes[rows])
        return Strings(self.doc[rows], self.key[rows], self.pos[rows], self.sizes[rows], data)

    def codes(self) -> tuple[np.ndarray, int]:
        """Number of the distinct string of each entry."""
        array = pa.Array.from_buffers(
            pa.large_binary(), len(self.doc),
            [None, pa.py_buffer(self.bounds), pa.py_buffer(np.ascontiguousarray(self.data))],
        ).dictionary_encode()
        return array.indices.to_numpy(), len(array.dictionary)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the runs of ``sizes`` places from ``starts``."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of many spans, one after the other; index arrays are kept small."""
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=data.dtype)
    at = done = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        out[done : ends[end - 1]] = data[ragged(starts[at:end], sizes[at:end])]
        at, done = end, int(ends[end - 1])
    return out


def least_of(values: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, _LAST, dtype=np.int64)
    np.minimum.at(out, codes, values)
    return out


def combine(found: Strings, spans: np.ndarray) -> tuple[Strings, np.ndarray, np.ndarray, tuple]:
    """Keep the entries of the smallest document per string; the others are decided.

    ``spans`` has the number of words of each entry.
    """
    codes, n = found.codes()
    stays = found.doc == least_of(found.doc, codes, n)[codes]
    gone = np.flatnonzero(~stays)
    reply = (found.doc[gone], found.key[gone], found.pos[gone], found.pos[gone] + spans[gone])
    if not len(gone):
        return found, codes, spans, reply
    rows = np.flatnonzero(stays)
    return found.take(rows), codes[rows], spans[rows], reply


def _super_kmers(words: W.Words, doc, key, window: int, gram: int):
    """Packed strings of a slice, their numbers of words, and their minimisers."""
    h, rows = words.hashes(), words.rows()
    if len(h) < window:
        return None
    grams = np.zeros(len(h) - gram + 1, dtype=np.uint64)
    for i in range(gram):
        grams += h[i : i + len(grams)] * W._ORDER[i]
    grams = W.mix(grams)
    inside = window - gram + 1
    least = sliding_window_view(grams, inside).argmin(axis=1) + np.arange(len(h) - window + 1)
    starts = np.flatnonzero(words.first[1:][rows[: len(least)]] - np.arange(len(least)) >= window)
    if not len(starts):
        return None
    at = least[starts]
    new = np.r_[True, (at[1:] != at[:-1]) | (rows[starts[1:]] != rows[starts[:-1]])]
    first = starts[new]
    last = starts[np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]]
    spans = last - first + window
    # Words joined by one space: of the blanks after a word only one is kept.
    blank = W.blanks(words.data)
    keep = ~blank
    after = words.ends[words.ends < len(blank)]
    keep[after] |= blank[after]
    place = np.concatenate([[0], np.cumsum(keep)])
    data = np.where(blank, np.uint8(32), words.data)[keep]
    a, b = place[words.starts[first]], place[words.ends[first + spans - 1]]
    owner = rows[first]
    found = Strings(
        doc[owner], key[owner], first - words.first[owner], b - a, gather(data, a, b - a)
    )
    return found, spans, grams[at[new]]


def _rows(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _by_window(found: Strings, window: int) -> tuple[Strings, np.ndarray]:
    """One string for each window of the strings, and a hash of all its words."""
    words = W.split_bytes(found.data, found.bounds)
    counts = words.counts - window + 1
    string = np.repeat(np.arange(len(counts)), counts)
    starts = ragged(words.first[:-1], counts)
    a, sizes = words.starts[starts], words.ends[starts + window - 1] - words.starts[starts]
    single = Strings(
        found.doc[string], found.key[string], found.pos[string] + starts - words.first[string],
        sizes, gather(words.data, a, sizes),
    )
    return single, W.mix(W.running(words.hashes(), starts, starts + window))


def _weigh(window: int, gram: int, buckets: int):
    """Bytes that the strings of each batch bring to each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.text_column(batch, "text")
            doc, key = batch.column("doc").to_numpy(), batch.column("key").to_numpy()
            for at, part in W.slices(texts, SLICE):
                end = at + len(part)
                made = _super_kmers(W.split(part), doc[at:end], key[at:end], window, gram)
                if made is None:
                    continue
                found, _, least = made
                codes, n = found.codes()
                rows = np.flatnonzero(found.doc == least_of(found.doc, codes, n)[codes])
                bucket, place = np.unique(least[rows] % np.uint64(buckets), return_inverse=True)
                size = np.bincount(place, weights=found.sizes[rows]).astype(np.int64)
                yield _rows(["bucket", "size"], bucket.astype(np.int64), size)
                W.give_back()

    return run


def overfull(
    documents: DataFrame, window: int, gram: int, buckets: int, bound: int, sample: int = SAMPLE
) -> list[int]:
    """Buckets whose strings take more than about ``bound`` bytes."""
    some = keyed(documents).filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0)
    sizes = some.mapInArrow(_weigh(window, gram, buckets), "bucket long, size long")
    large = sizes.groupBy("bucket").agg(F.sum("size").alias("n")).filter(F.col("n") > bound // sample)
    return [r.bucket for r in large.select("bucket").collect()]


def _deal(window: int, gram: int, buckets: int, split: list[int]):
    split = np.array(split, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.text_column(batch, "text")
            doc, key = batch.column("doc").to_numpy(), batch.column("key").to_numpy()
            for at, part in W.slices(texts, SLICE):
                end = at + len(part)
                made = _super_kmers(W.split(part), doc[at:end], key[at:end], window, gram)
                if made is None:
                    continue
                found, spans, least = made
                codes, n = found.codes()
                stays = found.doc == least_of(found.doc, codes, n)[codes]
                gone = np.flatnonzero(~stays)
                rows = np.flatnonzero(stays)
                bucket = (least[rows] % np.uint64(buckets)).astype(np.int64)
                decided = [(found.doc[gone], found.key[gone], found.pos[gone], spans[gone])]
                kept = found.take(rows)
                whole = ~np.isin(bucket, split)
                if not whole.all():
                    single, h = _by_window(kept.take(np.flatnonzero(~whole)), window)
                    codes, n = single.codes()
                    stays = single.doc == least_of(single.doc, codes, n)[codes]
                    gone, rows = np.flatnonzero(~stays), np.flatnonzero(stays)
                    decided.append((
                        single.doc[gone], single.key[gone], single.pos[gone],
                        np.full(len(gone), window),
                    ))
                    kept = Strings.joined([kept.take(np.flatnonzero(whole)), single.take(rows)])
                    bucket = np.r_[bucket[whole], (h[rows] % np.uint64(buckets)).astype(np.int64)]
                order = np.argsort(bucket, kind="stable")
                bucket = bucket[order]
                cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
                out = [kept.take(order[a:b]).pack() for a, b in zip(cuts[:-1], cuts[1:])]
                names = ["bucket", "decided", "packed"]
                yield _rows(names, bucket[cuts[:-1]], np.zeros(len(out), bool), out)
                gone = [np.concatenate(column) for column in zip(*decided)]
                if len(gone[0]):
                    # What is decided here rides along to the bucket of any string; which
                    # one differs between slices, so that no bucket gets them all.
                    any_of = int(found.doc[0] % len(bucket))
                    reply = Strings(*gone, np.zeros(0, np.uint8))
                    yield _rows(names, bucket[any_of : any_of + 1], np.ones(1, bool), [reply.pack()])
                del made, found, kept, out
                W.give_back()

    return run


def _same_windows(words: W.Words, starts: np.ndarray, window: int) -> np.ndarray:
    """Group number of each window: equal exactly when the words are equal."""
    h = W.mix(W.running(words.hashes(), starts, starts + window))
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.r_[True, s[1:] != s[:-1]]
    group = np.cumsum(new) - 1
    head = order[np.flatnonzero(new)][group]
    a, b = words.starts[starts], words.ends[starts + window - 1]
    size = b - a
    rest = np.flatnonzero(~new)
    differs = size[order[rest]] != size[head[rest]]
    step = max(1, CHUNK // (int(size.max()) + 1)) if len(size) else 1
    for k in range(0, len(rest), step):
        r = rest[k : k + step][~differs[k : k + step]]
        if not len(r):
            continue
        mine, other = order[r], head[r]
        n = size[mine]
        same = words.data[ragged(a[mine], n)] == words.data[ragged(a[other], n)]
        bad = ~np.logical_and.reduceat(same, np.cumsum(n) - n)
        differs[k : k + step][~differs[k : k + step]] = bad
    out = np.empty(len(h), dtype=np.int64)
    out[order] = group
    if differs.any():  # a chain of different windows under one hash
        extra = int(group[-1]) + 1
        for g in np.unique(group[rest[differs]]):
            known: dict[bytes, int] = {}
            for w in order[group == g]:
                out[w] = known.setdefault(words.data[a[w] : b[w]].tobytes(), extra + len(known))
            extra += len(known)
    return out


def _settle(found: Strings, window: int) -> tuple:
    """Spans of words that a smaller document also has, from one bucket's strings."""
    codes, n = found.codes()
    firsts = np.full(n, len(codes), dtype=np.int64)
    np.minimum.at(firsts, codes, np.arange(len(codes)))
    single = found.take(firsts)
    words = W.split_bytes(single.data, single.bounds)
    counts = words.counts - window + 1
    string = np.repeat(np.arange(n), counts)
    starts = ragged(words.first[:-1], counts)
    group = _same_windows(words, starts, window)
    least_doc = least_of(found.doc, codes, n)
    least = least_of(least_doc[string], group, int(group.max()) + 1)[group]
    opens = np.concatenate([[0], np.cumsum(counts)])
    lowest = np.minimum.reduceat(least, opens[:-1])
    hit = np.flatnonzero(lowest[codes] < found.doc)
    c = codes[hit]
    window_of = ragged(opens[:-1][c], counts[c])
    entry = np.repeat(hit, counts[c])
    flagged = least[window_of] < found.doc[entry]
    entry = entry[flagged]
    pos = found.pos[entry] + (window_of[flagged] - opens[:-1][codes[entry]])
    if not len(entry):
        return tuple(np.zeros((4, 0), np.int64))
    new = np.r_[True, (entry[1:] != entry[:-1]) | (pos[1:] != pos[:-1] + 1)]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(entry) - 1]
    e = entry[new]
    return found.doc[e], found.key[e], pos[new], pos[last] + window


def _count(window: int):
    """Sort and count the windows of each bucket; rows come in order of bucket."""

    def spans(found: Strings) -> np.ndarray:
        """Words of each string."""
        return np.add.reduceat(found.data == 32, found.bounds[:-1], dtype=np.int64) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Strings] = []
        size, compact, current = 0, 2 * BUCKET, None

        def reply(columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_REPLY)

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                found, _, _, gone = combine(joined := Strings.joined(held), spans(joined))
                del joined
                held.clear()
                yield reply(gone)
                yield reply(_settle(found, window))
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
                    found, _, _, gone = combine(joined := Strings.joined(held), spans(joined))
                    yield reply(gone)
                    held[:], size = [found], len(found.data)
                    compact = 2 * max(size, BUCKET)
        yield from close()

    return run


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the repeated spans out of each text and join what stays by one space."""
    for batch in batches:
        texts = W.text_column(batch, "text")
        spans = batch.column("spans")
        ids = batch.column("doc_id")
        for at, part in W.slices(texts):
            words = W.split(part)
            n_words, removed, kept = words.counts, [], []
            for k in range(len(part)):
                a, b = words.first[k], words.first[k + 1]
                stays = np.ones(b - a, dtype=bool)
                for span in spans[at + k].as_py() or ():
                    stays[span["start"] : span["end"]] = False
                removed.append(int(len(stays) - stays.sum()))
                text = words.data
                if a == b:
                    kept.append("")
                    continue
                row = text[words.starts[a] : words.ends[b - 1]]
                if removed[-1]:
                    s, e = words.starts[a:b][stays], words.ends[a:b][stays]
                    row = b" ".join(text[x:y].tobytes() for x, y in zip(s, e))
                else:
                    row = b" ".join(row.tobytes().split())
                kept.append(row.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, len(part)), pa.array(n_words),
                    pa.array(removed, pa.int64()), pa.array(kept, pa.large_string()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )


def dealt(
    documents: DataFrame, window: int, gram: int, buckets: int, bound: int, sample: int = SAMPLE
) -> DataFrame:
    """Packed strings of all documents and the bucket of each pack."""
    split = overfull(documents, window, gram, buckets, bound, sample)
    return keyed(documents).mapInArrow(
        _deal(window, gram, buckets, split), "bucket long, decided boolean, packed binary"
    )


def repeated_spans(
    documents: DataFrame, window: int = 13, gram: int = 3, buckets: int | None = None,
    bound: int = 4 * BUCKET, sample: int = SAMPLE,
) -> DataFrame:
    """``doc``, ``key`` and the word span [start, end) of every repeated passage.

    ``key`` is a 64-bit hash of the text, which tells rows with one doc_id apart.  Spans of
    one document may overlap.
    """
    spark = documents.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if buckets is None:
        size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(tasks, 4 * size // BUCKET)
    return (
        dealt(documents, window, gram, buckets, bound, sample)
        .repartition(max(tasks, min(buckets, 20_000)), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_count(window), "doc long, key long, start long, end long")
    )


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(_LAST)).alias("doc"),
        F.xxhash64("text").alias("key"),
        "text",
    )


def without_repeats(documents: DataFrame, window: int = 13, gram: int = 3) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_text`` of every document.

    A word goes when a window that covers it also starts in a document with a smaller
    doc_id; all windows are judged on the input.
    """
    spans = materialize(
        repeated_spans(documents, window, gram)
        .groupBy("doc", "key")
        .agg(F.collect_list(
            F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
        ).alias("spans")),
        "spans",
    )
    rows = maybe_in(keyed(documents), spans, ["doc", "key"], "__cut")
    # Only texts that may lose words travel to meet their spans.
    cut = (
        rows.filter("__cut").join(spans.hint("shuffle_hash"), ["doc", "key"], "left")
        .select("doc_id", "text", "spans")
    )
    whole = rows.filter("not __cut").select(
        "doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")
    )
    out = "doc_id long, n_words long, n_removed long, kept_text string"
    return cut.mapInArrow(_keep, out).unionByName(whole.mapInArrow(_keep, out))
