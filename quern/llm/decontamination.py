"""Benchmark decontamination by a BM25 index of test items and block-max WAND.

The test items are the indexed documents; every passage of every training text is a
query.  Passages are windows of 2 L words that advance by L, L being the length of the
longest item, so each run of L words lies whole in some passage.  A posting's impact
is the item's BM25 weight for the term divided by the item's weight against itself:
a score of 1 means that all its terms are there, and one threshold serves all items.

The passages of a slice of texts are searched together: the WAND pivot rule picks the
posting lists that are merged, block-maximum impacts bound the items met there, and
only items whose bound reaches the threshold are scored.  Retrieved items are
verified: the share of the question's and of the answer's word shingles that occur in the
passage must both reach ``overlap``.  Shingles have five words; in parts of fewer than 15
words they have two, and of fewer than six, one, so that one changed word does not hide a
short answer.

An item's answer is what follows its last question mark; an item without one is verified
as a whole, and both shares are its own.  Postings with their impacts are a table in the
shared folder, computed by Spark.  They are broadcast in blocks of about ``INDEX_WORDS``
words of items; a larger benchmark is searched block after block, over all texts, and the
leaks of a block are stored before the next one is loaded.

Defined results: NULL or empty items and texts match nothing; repeated items are
reported each; rows that repeat a doc_id are judged one by one; very long texts are
searched passage by passage to their end; an empty benchmark or table gives no leaks;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import words as W
from quern.llm.tokenizing import ragged
from quern.session import materialize

K1, B = 1.2, 0.75
SHINGLE = 5
INDEX_WORDS = 1_000_000
EPSILON = 1e-9
_LEAKS = pa.schema(
    [
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
        ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
        ("first_word", pa.int64()),
    ]
)
_LEAKS_DDL = (
    "doc_id long, item_id long, score double, question_overlap double, "
    "answer_overlap double, first_word long"
)


def answer_start(text: str) -> int:
    """Where the answer of an item begins, in characters; 0 if it has no question."""
    marks = [m.end() for m in re.finditer(r"[?¿]\s+(?=\S)", text)]
    return marks[-1] if marks else 0


def shingle_width(words: int) -> int:
    """Words of a shingle, for a part of an item with so many words."""
    return SHINGLE if words >= 3 * SHINGLE else 2 if words > SHINGLE else 1


def _parse_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = W.text_column(batch, "text")
        plain = texts.to_pylist()
        cut = [answer_start(t) for t in plain]
        heads = pa.array([t[:c] for t, c in zip(plain, cut)], pa.large_string())
        words, head = W.terms(texts), W.terms(heads)
        h = words.hashes().view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item_id"),
                pa.LargeListArray.from_arrays(pa.array(words.first), pa.array(h)).cast(pa.list_(pa.int64())),
                pa.array(head.counts.astype(np.int32)),
            ],
            names=["item_id", "words", "question_words"],
        )


def _shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the distinct shingles of a part of an item."""
    return np.unique(_runs(words, shingle_width(len(words))))


@dataclass
class Index:
    """Postings of a block of items, in order of item inside each term."""

    item_ids: list
    words: list[np.ndarray]
    question: list[int]
    terms: np.ndarray  # sorted hashes
    starts: np.ndarray  # postings of term k: starts[k] .. starts[k + 1]
    items: np.ndarray
    impacts: np.ndarray
    most: np.ndarray  # largest impact per term
    block: int  # items per block
    block_most: np.ndarray  # largest impact per term and block
    length: int  # words of the longest item
    postings: np.ndarray  # term * number of items + item, ascending

    @staticmethod
    def build(rows: list) -> Index:
        """Index of items with their ``words`` and their ``postings`` (term, impact)."""
        words = [np.array(r["words"], np.int64).view(np.uint64) for r in rows]
        sizes = [len(r["postings"]) for r in rows]
        item = np.repeat(np.arange(len(rows)), sizes)
        term = np.array([p["term"] for r in rows for p in r["postings"]], np.int64).view(np.uint64)
        impact = np.array([p["impact"] for r in rows for p in r["postings"]], float)
        order = np.lexsort((item, term))
        terms, starts = np.unique(term[order], return_index=True)
        starts = np.r_[starts, len(order)]
        item, impact = item[order], impact[order]
        block = max(8, -(-len(words) // 32))
        of_term = np.repeat(np.arange(len(terms)), np.diff(starts))
        block_most = np.zeros((len(terms), -(-len(words) // block)), np.float32)
        np.maximum.at(block_most, (of_term, item // block), impact.astype(np.float32) * 1.000001)
        return Index(
            [r["item_id"] for r in rows], words, [r["question_words"] for r in rows],
            terms, starts, item, impact, np.maximum.reduceat(impact, starts[:-1]), block,
            block_most, max(map(len, words)), of_term * len(words) + item,
        )


def wand(
    index: Index, passage: np.ndarray, term: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (passage, item, score) with a score of at least ``threshold``.

    ``passage`` and ``term`` are distinct pairs, passages numbered from 0 in order.
    Many queries advance together.  The terms of each are ordered by their largest
    impact; the pivot is the first term where these maxima add up to the threshold.
    An item without a term from the pivot on cannot reach it, so only the lists from
    the pivot on are merged.  What an item has there, plus the block maxima of the
    terms before the pivot, bounds its score; an item below is skipped.  For the rest,
    the lists before the pivot are searched.
    """
    n_items = len(index.words)
    most = index.most[term]
    order = np.lexsort((most, passage))
    passage, term, most = passage[order], term[order], most[order]
    starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    upto = np.cumsum(most)
    number = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(term)]))
    upto -= (upto[starts] - most[starts])[number]
    late = upto >= threshold - EPSILON
    before = np.bincount(number[~late], minlength=len(starts))

    lists = term[late]
    sizes = index.starts[lists + 1] - index.starts[lists]
    rows = ragged(index.starts[lists], sizes)
    merged = np.repeat(number[late], sizes) * n_items + index.items[rows]
    key, place = np.unique(merged, return_inverse=True)
    score = np.bincount(place, index.impacts[rows], minlength=len(key))
    query, item = key // n_items, key % n_items

    bounds = np.zeros((len(starts), index.block_most.shape[1]), np.float32)
    some = before > 0
    if some.any():
        early = np.flatnonzero(~late)
        first = np.concatenate([[0], np.cumsum(before)])[:-1][some]
        bounds[some] = np.add.reduceat(index.block_most[term[early]], first, axis=0)
    alive = score + bounds[query, item // index.block] >= threshold - EPSILON
    query, item, score = query[alive], item[alive], score[alive]

    sizes = before[query]
    wanted = term[ragged(starts[query], sizes)] * n_items + np.repeat(item, sizes)
    postings = index.postings
    at = np.minimum(np.searchsorted(postings, wanted), len(postings) - 1)
    impact = np.where(postings[at] == wanted, index.impacts[at], 0.0)
    score += np.bincount(np.repeat(np.arange(len(query)), sizes), impact, minlength=len(query))
    found = score >= threshold - EPSILON
    return passage[starts[query[found]]], item[found], score[found]


def _overlap(have: np.ndarray, want: np.ndarray) -> float:
    return float(np.isin(want, have).mean()) if len(want) else 1.0


def _leaks_of(index: Index, texts: pa.Array, threshold: float, overlap: float) -> list[tuple]:
    """(row, item, score, overlaps, first word) of the leaks in a slice of texts."""
    words = W.terms(texts)
    h, length = words.hashes(), max(index.length, 1)
    place = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
    hit = np.flatnonzero(index.terms[place] == h)
    if not len(hit):
        return []
    rows = words.rows()[hit]
    segments = -(-words.counts // length)
    passages = np.maximum(segments - 1, np.minimum(segments, 1))
    base = np.concatenate([[0], np.cumsum(passages)])
    segment = (hit - words.first[rows]) // length
    term = place[hit]
    here, back = segment < passages[rows], segment > 0
    number = np.r_[base[rows[here]] + segment[here], base[rows[back]] + segment[back] - 1]
    key = np.unique(number * len(index.terms) + np.r_[term[here], term[back]])
    passage, term = key // len(index.terms), key % len(index.terms)
    best: dict[tuple[int, int], tuple] = {}
    have, shown = None, -1
    for p, item, score in zip(*(x.tolist() for x in wand(index, passage, term, threshold))):
        row = int(np.searchsorted(base, p, "right")) - 1
        a = int(words.first[row]) + (p - int(base[row])) * length
        b = min(a + 2 * length, int(words.first[row + 1]))
        if p != shown:
            have, shown = {n: _runs(h[a:b], n) for n in (1, 2, SHINGLE)}, p
        q = index.question[item]
        parts = (index.words[item][:q], index.words[item][q:]) if q else (index.words[item],) * 2
        shares = [_overlap(have[shingle_width(len(x))], _shingles(x)) for x in parts]
        if min(shares) >= overlap:
            old = best.get((row, item))
            if old is None or score > old[0]:
                best[row, item] = (score, *shares, a - int(words.first[row]))
    return [(row, item, *rest) for (row, item), rest in best.items()]


def _runs(words: np.ndarray, n: int) -> np.ndarray:
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total += words[i : i + len(total)] * W._ORDER[i]
    return W.mix(total)


def _search(index: Index, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = W.text_column(batch, "text"), batch.column("doc_id")
            for at, part in W.slices(texts):
                found = _leaks_of(index, part, threshold, overlap)
                if found:
                    row, item, *rest = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(at, len(part)).take(pa.array(row)),
                            pa.array([index.item_ids[i] for i in item], pa.int64()),
                            *(pa.array(x, f.type) for x, f in zip(rest, list(_LEAKS)[2:])),
                        ],
                        schema=_LEAKS,
                    )
            W.give_back()

    return run


def item_postings(benchmark: DataFrame) -> DataFrame:
    """The stored items: ``item_id``, ``words``, ``question_words``, and their
    ``postings``, each a term with its impact, from document frequencies over all items."""
    items = materialize(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .mapInArrow(_parse_items, "item_id long, words array<long>, question_words int")
        .filter(F.size("words") > 0)
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    n, mean = items.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
    counted = (
        items.select("item", F.size("words").alias("size"), F.explode("words").alias("term"))
        .groupBy("item", "size", "term").agg(F.count(F.lit(1)).alias("tf"))
    )
    df = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("size") / F.lit(mean or 1.0))
    weighed = counted.join(df, "term").select(
        "item", "term", (idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("weight")
    )
    per_item = weighed.groupBy("item").agg(
        F.sum("weight").alias("all"), F.collect_list(F.struct("term", "weight")).alias("terms")
    )
    postings = F.transform(
        F.array_sort("terms"),
        lambda t: F.struct(t["term"].alias("term"), (t["weight"] / F.col("all")).alias("impact")),
    )
    return materialize(
        items.join(per_item, "item").select("item_id", "words", "question_words", postings.alias("postings")),
        "item-postings",
    )


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.4,
    overlap: float = 0.5,
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """Test items found in documents: ``doc_id``, ``item_id``, ``score``,
    ``question_overlap``, ``answer_overlap``, ``first_word`` of the best passage."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = item_postings(benchmark)
    total = items.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    blocks = -(-total // index_words)
    block = F.pmod(F.xxhash64("item_id", "words"), F.lit(max(blocks, 1)))
    found = spark.createDataFrame([], _LEAKS_DDL)
    for k in range(blocks):
        own = items.filter(block == k).collect()  # about index_words words
        if not own:
            continue
        leaks = rows.mapInArrow(_search(Index.build(own), threshold, overlap), _LEAKS_DDL)
        found = found.unionByName(leaks if blocks == 1 else materialize(leaks, "block-leaks"))
    return found


def without_leaks(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents in which no test item was found, with all their columns.

    Rows are told apart by doc_id and a hash of the text, NULL included.
    """
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    # find_leaks passes an id through; here that is the row's key.
    keyed = documents.select(key.alias("doc_id"), "text")
    # Stored first: its size is known when the join is planned, and few leaks spare
    # all texts a shuffle.
    leaks = materialize(
        find_leaks(keyed, benchmark, **options).select(F.col("doc_id").alias("__leak")).distinct(),
        "leaks",
    )
    return documents.join(leaks, key == F.col("__leak"), "left_anti")
