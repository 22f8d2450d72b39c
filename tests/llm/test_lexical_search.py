"""Ranked search against full scoring in plain Python."""

import math
import random
import re
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest

from quern.llm import lexical_search as search
from quern.llm.shipping import ship

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string, rank string, score string"
DOC = "doc_id long, text string, rank string, item string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def terms(text):
    return TERM.findall((text or "").translate(cases.LOWER))


def expected(documents, items, limit):
    bags = [(i, Counter(terms(t))) for i, t in documents]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in {(i, t or "") for i, t in items}:
        scored = []
        for doc, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n // total
            score = 0
            for t in terms(text):
                if t in bag:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += weight * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored)[:limit], 1):
            out[item, rank, doc, -score] += 1
    return out


def run(spark, documents, items, limit, **sizes):
    docs = spark.createDataFrame([(*d, "x", "y") for d in documents], DOC)
    asked = spark.createDataFrame([(*i, "x", "y") for i in items], ITEM)
    found = search.search(search.build_index(docs), asked, limit, **sizes)
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect())


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 120)))) for i in range(n)]


@pytest.mark.parametrize("limit", [1, 5, 1000])
def test_equals_full_scoring(spark, limit):
    documents = corpus(400, 1)
    items = [(i, t + " W0 w250 w250") for i, (_, t) in enumerate(corpus(12, 2))]
    assert run(spark, documents, items, limit) == expected(documents, items, limit)


def test_groups_of_items_and_equal_texts(spark):
    documents = corpus(60, 3)
    items = [(i, t) for i, (_, t) in enumerate(corpus(9, 4))] + [(100, "w1 w2"), (101, "w1 w2"), (100, "w1 w2")]
    assert run(spark, documents, items, 3, group_bytes=300) == expected(documents, items, 3)


def test_awkward_rows(spark):
    documents = [(i, t) for i, t, *_ in cases.AWKWARD] + [(70, "x" * 300_000), (71, "tie"), (None, "tie"), (9, "tie")]
    items = [
        (1, cases.BASE), (2, None), (3, ""), (4, "..."), (5, "TIE"), (None, "tie"), (6, "no such term"),
        (7, cases.ITEM), (7, cases.ITEM), (8, "Ünïcödé ÜNÏCÖDÉ 日本語"), (9, "x" * 300_000),
    ]
    assert run(spark, documents, items, 20) == expected(documents, items, 20)


def test_empty_tables(spark):
    assert not run(spark, [], [(1, "a")], 20)
    assert not run(spark, [(1, "a")], [], 20)


def test_windows_and_documents_are_skipped():
    documents = corpus(3000, 5)
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in documents], "text": [t for _, t in documents]})
    (row,) = [r for out in search._blocks(iter([batch])) for r in [{n: out.column(n)[0] for n in out.schema.names}]]
    row = {n: v.values if n in ("ids", "lengths", "terms", "df") else v.as_py() for n, v in row.items()}
    vocabulary = row["terms"].cast(pa.large_string())
    weights = np.floor(1000 * np.log(6002 / (2 * row["df"].to_numpy() + 1))).astype(np.int64)
    total = sum(row["lengths"].to_pylist())
    block = search.Block(row, vocabulary, vocabulary, search.Collection(3000, total, weights))
    names = vocabulary.to_pylist()
    asked = np.array([names.index(f"w{i}") for i in (0, 1, 3, 120, 200, 260)])
    for short in (None, 0, 10**9):  # short lists as usual, only long ones, only short ones
        best, work = search.Best(10), search.Work()
        search.search_block(block, asked, weights[asked], best, work, short)
        whole = np.zeros(block.n, np.int64)
        for t in asked:
            span = slice(block.start[t], block.end[t])
            whole[block.rows[span]] += weights[t] * block.impact[span]
        order = np.lexsort((np.arange(block.n), -whole))[:10]
        assert best.doc.tolist() == order.tolist() and best.score.tolist() == whole[order].tolist()
        again = search.Work()
        search.search_block(block, asked, weights[asked], best, again, short)
        assert again.skipped >= work.skipped and again.looked <= work.looked
        assert again.skipped > 0


def test_long_collections_keep_integers_exact():
    length = np.array([1, 10**9], np.int64)
    found = search.impacts(np.array([1, 2]), length, 10**12, 10**14)
    for got, tf, n in zip(found, (1, 2), length.tolist()):
        assert got == 10**9 * tf // (1000 * tf + 12 * (75 + 25 * n * 10**12 // 10**14))
