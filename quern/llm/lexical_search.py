"""Ranked lexical search: accumulators from short lists, documents at a time on long ones.

Index.  Tasks cut the documents into blocks.  A block holds its documents' ids and
lengths, its terms, and for each term the list of its documents with their counts.  All
documents and terms are indexed; blocks are rows of a table in the shared folder, so a
search reads them in parallel, and only the columns that it needs.

Search.  Distinct item texts are taken in groups of bounded size.  For each group the
document frequencies of its terms are summed over all blocks; then every block is
searched for every item of the group:

1. Term at a time: the item's shortest lists are added up into accumulators, which from
   then on are one iterator over documents with a bound per window of documents.
2. Document at a time: windows are visited in document order.  The bounds of the
   accumulators and of each long list in the window are added; a window that cannot
   reach the threshold (the score of the item's last-placed document so far) is skipped.
   In the others, documents are looked up in one long list after the other, the one that
   can add most first, and dropped as soon as what the rest can add is not enough.

A task keeps the best documents per item, and thus the threshold, from block to block.
The best of all tasks are merged by Spark in two steps.

A term's weight is floor(1000 * ln((2N + 2) / (2df + 1))), everything else is 64-bit
integer arithmetic: see ``impacts``.

Defined results: NULL or termless documents are in no list; an item without known terms
has no rows; equal scores go by ascending doc_id, NULL last; rows that repeat a doc_id
are documents of their own; items that repeat (item_id and text) are answered once;
empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm import words as W
from quern.session import materialize

SLICE = 4 << 20
#: Bytes of item texts that are searched for at once; the only data sent to all tasks.
GROUP_BYTES = 4 << 20
#: Documents in a window with bounds of its own.
WINDOW = 32
#: Windows that are looked into before the threshold is raised.
AT_ONCE = 16
_LAST = np.iinfo(np.int64).max

_CODES = np.arange(256)
_IS_TERM = (
    (_CODES >= 0x80) | ((_CODES >= 48) & (_CODES <= 57))
    | ((_CODES >= 65) & (_CODES <= 90)) | ((_CODES >= 97) & (_CODES <= 122))
)


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of all rows, A-Z lowered, and the number of terms of each row."""
    data, bounds = W.text_bytes(texts)
    inside = _IS_TERM[data]
    words = W.split_bytes(data, bounds, ~inside)
    sizes = words.ends - words.starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    kept = np.ascontiguousarray(W.lower_ascii(data[inside]))
    terms = pa.Array.from_buffers(
        pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
    )
    return terms, words.counts


def _squeeze(values: np.ndarray) -> bytes:
    kind = np.min_scalar_type(int(values.max(initial=0)))
    raw = bytes([kind.itemsize]) + values.astype(kind).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _stretch(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("doc_id"), W.text_column(batch, "text")
        for at, part in W.slices(texts, SLICE):
            terms, counts = split_terms(part)
            has = np.flatnonzero(counts)
            if not len(has):
                continue
            coded = terms.dictionary_encode()
            row = np.repeat(np.arange(len(has)), counts[has])
            key = coded.indices.to_numpy().astype(np.int64) * len(has) + row
            key, times = np.unique(key, return_counts=True)
            df = np.bincount(key // len(has), minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.slice(at, len(part)).take(pa.array(has))], pa.list_(pa.int64())),
                    pa.array([counts[has]], pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(
                        pa.array([0, len(df)], pa.int32()), coded.dictionary.cast(pa.string())
                    ),
                    pa.array([df], pa.list_(pa.int64())),
                    pa.array([_squeeze(key % len(has))], pa.binary()),
                    pa.array([_squeeze(times)], pa.binary()),
                    pa.array([len(has)], pa.int64()), pa.array([int(counts.sum())], pa.int64()),
                ],
                names=["ids", "lengths", "terms", "df", "rows", "times", "n_docs", "n_terms"],
            )
            del terms, coded, key, row
            W.give_back()


_BLOCK = (
    "ids array<long>, lengths array<long>, terms array<string>, df array<long>, "
    "rows binary, times binary, n_docs long, n_terms long"
)


def build_index(documents: DataFrame) -> DataFrame:
    """The stored index of ``doc_id`` and ``text``: one row per block of documents."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialize(rows.mapInArrow(_blocks, _BLOCK), "lexical-index")


def _frequencies(vocabulary: pa.Array):
    """Document frequencies of the vocabulary in the blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            terms, df = batch.column(0).flatten(), batch.column(1).flatten()
            known = pc.index_in(terms.cast(pa.large_string()), value_set=vocabulary)
            hit = np.asarray(known.is_valid())
            place = known.drop_null().to_numpy()
            total += np.bincount(place, weights=df.to_numpy()[hit], minlength=len(total)).astype(np.int64)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(total[place])], names=["term", "df"]
        )

    return run


@dataclass
class Collection:
    """Counts over all documents: how many, how many terms, and those of each term."""

    n_docs: int
    n_terms: int
    weights: np.ndarray

    @staticmethod
    def of(index: DataFrame, vocabulary: pa.Array) -> Collection:
        n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        found = (
            index.select("terms", "df").mapInArrow(_frequencies(vocabulary), "term long, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # a row per term of the group
        )
        df = np.zeros(len(vocabulary), np.int64)
        df[found["term"].to_numpy()] = found["df"].to_numpy()
        ratio = np.float64(2 * (n_docs or 0) + 2) / (2 * df + 1).astype(np.float64)
        weights = np.floor(1000 * np.log(ratio)).astype(np.int64)
        return Collection(n_docs or 0, n_terms or 0, np.where(df > 0, weights, 0))


def impacts(times: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10 ** 9 * tf) div (1000 * tf + 12 * m), m = 75 + (25 * length * n_docs) div n_terms."""
    if 25 * n_docs * int(length.max(initial=0)) < 2**63:
        m = 75 + 25 * length * n_docs // n_terms
    else:
        m = np.array([75 + 25 * int(n) * n_docs // n_terms for n in length], np.int64)
    return 10**9 * times // (1000 * times + 12 * m)


class Block:
    """Lists of the terms of a vocabulary in one block, with impacts and window bounds."""

    def __init__(self, row: dict, terms: pa.Array, vocabulary: pa.Array, stats: Collection):
        self.ids, lengths = row["ids"], row["lengths"].to_numpy()
        self.n = len(lengths)
        df = row["df"].to_numpy()
        ends = np.cumsum(df)
        code = pc.index_in(vocabulary, value_set=terms).fill_null(-1).to_numpy()
        known = code >= 0
        self.rows, times = _stretch(row["rows"]), _stretch(row["times"])
        self.start = np.where(known, (ends - df)[code], 0)
        self.end = np.where(known, ends[code], 0)
        used = ragged(self.start[known], (self.end - self.start)[known])
        self.impact = np.zeros(len(self.rows), np.int64)
        self.impact[used] = impacts(
            times[used], lengths[self.rows[used]], stats.n_docs, stats.n_terms
        )
        # The largest impact of each list in each window that it has documents in.
        term = np.repeat(np.arange(len(df)), df)
        place = term * (-(-self.n // WINDOW)) + self.rows // WINDOW
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else place
        self.window = self.rows[first] // WINDOW
        self.highest = np.maximum.reduceat(self.impact, first) if len(first) else self.impact
        self.low = np.searchsorted(first, self.start)
        self.high = np.searchsorted(first, self.end)
        self.top = np.zeros(len(code), np.int64)
        for t in np.flatnonzero(known):
            self.top[t] = self.highest[self.low[t] : self.high[t]].max()

    @property
    def windows(self) -> int:
        return -(-self.n // WINDOW)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the runs of ``sizes`` places from ``starts``."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


@dataclass
class Best:
    """The best documents of one item so far."""

    limit: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    null: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    @property
    def threshold(self) -> int:
        """A document below this score cannot enter."""
        return int(self.score[-1]) if len(self.score) == self.limit else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        null = np.concatenate([self.null, null])
        order = np.lexsort((doc, null, -score))[: self.limit]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


@dataclass
class Work:
    """What a search did: documents looked up on long lists, and windows skipped."""

    looked: int = 0
    skipped: int = 0


def search_block(
    block: Block, terms: np.ndarray, weights: np.ndarray, best: Best, work: Work | None = None,
    short: int | None = None,
) -> None:
    """Add an item's best documents of a block; ``weights`` has each term's whole weight."""
    size = block.end[terms] - block.start[terms]
    used = (size > 0) & (weights > 0)
    terms, weights, size = terms[used], weights[used], size[used]
    if not len(terms) or int((weights * block.top[terms]).sum()) < best.threshold:
        return
    order = np.argsort(size, kind="stable")
    terms, weights, size = terms[order], weights[order], size[order]
    n_short = int(np.searchsorted(np.cumsum(size), block.n // 2 if short is None else short, "right"))

    # Term at a time: one iterator of summed accumulators.
    sums = np.zeros(block.windows * WINDOW, np.int64)
    for t, w in zip(terms[:n_short], weights[:n_short]):
        span = slice(block.start[t], block.end[t])
        sums[block.rows[span]] += w * block.impact[span]
    bound = sums.reshape(-1, WINDOW).max(axis=1)

    # Document at a time over that iterator and the long lists, the strongest first.
    order = n_short + np.argsort(-(weights * block.top[terms])[n_short:], kind="stable")
    terms, weights = terms[order], weights[order]
    rest = np.zeros((len(terms) + 1, block.windows), np.int64)
    for i in range(len(terms) - 1, -1, -1):
        span = slice(block.low[terms[i]], block.high[terms[i]])
        rest[i] = rest[i + 1]
        rest[i, block.window[span]] += weights[i] * block.highest[span]
    bound = bound + rest[0]
    waiting = np.flatnonzero(bound >= best.threshold)
    if work is not None:
        work.skipped += block.windows - len(waiting)
    while len(waiting):
        now, waiting = waiting[:AT_ONCE], waiting[AT_ONCE:]
        docs = (now[:, None] * WINDOW + np.arange(WINDOW)).ravel()
        score, window = sums[docs], docs // WINDOW
        for i, (t, w) in enumerate(zip(terms, weights)):
            stays = score + rest[i, window] >= best.threshold
            docs, score, window = docs[stays], score[stays], window[stays]
            if not len(docs):
                break
            if work is not None:
                work.looked += len(docs)
            rows = block.rows[block.start[t] : block.end[t]]
            place = np.searchsorted(rows, docs)
            hit = np.flatnonzero(rows[np.minimum(place, len(rows) - 1)] == docs)
            score[hit] += w * block.impact[block.start[t] + place[hit]]
        good = np.flatnonzero(score >= best.threshold)
        if len(good):
            found = block.ids.take(pa.array(docs[good]))
            best.add(
                score[good], found.fill_null(0).to_numpy(zero_copy_only=False),
                np.asarray(found.is_null()),
            )
            late = bound[waiting] < best.threshold
            if work is not None:
                work.skipped += int(late.sum())
            waiting = waiting[~late]


def _search(vocabulary: pa.Array, items: list[tuple[np.ndarray, np.ndarray]], stats: Collection, limit: int):
    """The best documents of a task's blocks for each item (terms, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(limit) for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].values for n in ("ids", "lengths", "terms", "df")}
                row |= {n: batch.column(n)[i].as_py() for n in ("rows", "times")}
                block = Block(row, row["terms"].cast(pa.large_string()), vocabulary, stats)
                for own, (terms, times) in zip(best, items):
                    search_block(block, terms, times * stats.weights[terms], own)
                del row, block
            W.give_back()
        sizes = [len(b.score) for b in best]
        if sum(sizes):
            ids = pa.array(
                np.concatenate([b.doc for b in best]), mask=np.concatenate([b.null for b in best])
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(best), dtype=np.int32), sizes)), ids,
                    pa.array(np.concatenate([b.score for b in best])),
                ],
                names=["item", "doc_id", "score"],
            )

    return run


def _top(rows: DataFrame, limit: int, *groups: str) -> DataFrame:
    best = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= limit)


def _search_texts(index: DataFrame, texts: list[str], limit: int) -> DataFrame:
    terms, counts = split_terms(pa.array(texts, pa.large_string()))
    coded = terms.dictionary_encode()
    codes, ends = coded.indices.to_numpy(), np.cumsum(counts)
    items = [np.unique(codes[e - n : e], return_counts=True) for n, e in zip(counts, ends)]
    vocabulary = coded.dictionary
    stats = Collection.of(index, vocabulary)
    found = index.select("ids", "lengths", "terms", "df", "rows", "times").mapInArrow(
        _search(vocabulary, items, stats, limit), "item int, doc_id long, score long"
    )
    # Every task sends up to `limit` rows per item: thin them out in parts, then as a whole.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    few = _top(found.withColumn("part", part), limit, "item", "part").drop("rank", "part")
    return _top(few, limit, "item")


def search(
    index: DataFrame, items: DataFrame, limit: int = 20, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's best documents."""
    spark = items.sparkSession
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    texts = rows.select("text").distinct()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = -(-size // group_bytes) or 1
    number = F.pmod(F.xxhash64("text"), F.lit(groups))
    answers = None
    for g in range(groups):
        group = [r.text for r in texts.filter(number == g).collect()]
        found = _search_texts(index, group, limit)
        if groups > 1:
            found = materialize(found, "search-group")
        asked = spark.createDataFrame(list(enumerate(group)), "item int, text string")
        found = found.join(F.broadcast(asked), "item")  # about group_bytes
        answers = found if answers is None else answers.unionByName(found)
    return rows.join(answers, "text").select("item_id", "rank", "doc_id", "score")
