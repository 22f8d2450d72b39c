"""Removed byte strings against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm import suffix_dedup as suffix
from quern.llm import substring_dedup
from quern.llm.shipping import ship

KIND = "doc_id long, text string, spans string, key string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def expected(rows, length=100):
    """``rows``: (order, doc_id, text); equal orders are one document."""
    data = [(order, doc, (text or "").encode()) for order, doc, text in rows]
    first = {}
    for order, _, text in data:
        for i in range(len(text) - length + 1):
            key = text[i : i + length]
            first[key] = min(first.get(key, (order, i)), (order, i))
    out = Counter()
    for order, doc, text in data:
        stays = np.ones(len(text), bool)
        for i in range(len(text) - length + 1):
            if first[text[i : i + length]] < (order, i):
                stays[i : i + length] = False
        gone = np.r_[False, ~stays]
        kept = np.frombuffer(text, np.uint8)[stays].tobytes()
        out[doc, len(text), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), kept] += 1
    return out


def ordered(spark, rows):
    """Place of each row: NULL ids last, then by the hash of the text."""
    frame = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    keys = [r[0] for r in frame.select(F.xxhash64("text")).coalesce(1).collect()]
    return [((i is None, i or 0, k), i, t) for (i, t), k in zip(rows, keys)]


def run(spark, rows, length=100, parts=4, **limits):
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], KIND).repartition(parts)
    found = suffix.without_repeated_bytes(frame, length, **limits).collect()
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)


def shared(seed, n, alphabet="abcdé 日"):
    rng = random.Random(seed)

    def text(k):
        return "".join(rng.choice(alphabet) for _ in range(k))

    passages = [text(rng.randrange(30, 400)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(5)):
            parts.append(text(rng.randrange(60)))
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            parts.append(rng.choice([p, p, p[cut:], p[:cut], p[: cut // 2] + "#" + p[cut // 2 :]]))
        rows.append((rng.randrange(n), "".join(parts)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"buckets": 3}, {"buckets": 64, "bound": 2000, "sample": 1}])
def test_equals_plain_search(spark, limits):
    rows = shared(1, 60)
    assert run(spark, rows, **limits) == expected(ordered(spark, rows))


def test_other_lengths(spark):
    rows = shared(2, 30)
    for length in (33, 40, 150):
        assert run(spark, rows, length) == expected(ordered(spark, rows), length)
    with pytest.raises(ValueError):
        run(spark, rows, 32)


def test_periodic_texts(spark):
    rows = [(1, "a" * 1000), (2, "ab" * 300), (3, "b" + "a" * 150), (4, "abc" * 100 + "a" * 120), (5, "a" * 99)]
    assert run(spark, rows) == expected(ordered(spark, rows))


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 256)
    rows = shared(3, 12) + [(50, "".join(t for _, t in shared(3, 30)))]
    ids = ordered(spark, rows)
    doc = np.array([i for _, i, _ in ids], np.int64)
    key = np.array([o[2] for o, _, _ in ids], np.int64)
    batch = pa.RecordBatch.from_pydict({"doc": doc, "key": key, "text": [t for _, _, t in ids]})
    found = suffix.Strings.joined([s for s, _ in suffix._pools(iter([batch]), 100)])
    starts = Counter(
        (d, k, p + i) for d, k, p, n in zip(found.doc, found.key, found.pos, found.sizes) for i in range(n - 99)
    )
    assert starts == Counter(
        (i, o[2], p) for o, i, t in ids for p in range(len(t.encode()) - 99)
    )


def test_awkward_rows(spark):
    long = "tail " * 40
    rows = [(i, t if len(t or "") < 10_000 else t[:8000]) for i, t, *_ in cases.AWKWARD]
    rows += [(None, long + "one"), (None, long + "two"), (None, long + "two"), (5, long), (5, "x" + long)]
    rows += [(7, None), (7, ""), (7, None)]
    assert run(spark, rows) == expected(ordered(spark, rows))


def test_empty_table(spark):
    assert not run(spark, [])


def test_edges_of_a_frequent_passage_are_dealt_by_start(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))  # shorter than the length
    rows = [
        (i, "".join(rng.choice("xyz") for _ in range(60)) + passage * (i % 3 > 0) + f"{i:060d}")
        for i in range(900)
    ]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], KIND).repartition(4)
    keyed, largest = suffix.keyed(frame), {}
    for bound in (1 << 40, 1 << 12):
        splits = suffix.overfull(keyed, 100, 512, bound, 1)
        assert len(splits) == (2 if bound < 1 << 40 else 0)  # both levels of anchors
        size = Counter()
        dealt = keyed.mapInArrow(suffix._deal(100, 512, splits), "bucket long, decided boolean, packed binary")
        for r in dealt.filter("not decided").collect():
            size[r.bucket] += len(suffix.Strings.unpack(bytes(r.packed)).data)
        largest[bound] = max(size.values())
    assert largest[1 << 40] > 2 * largest[1 << 12]
    assert run(spark, rows, buckets=512, bound=1 << 12, sample=1) == expected(ordered(spark, rows))


def test_long_frequent_passages_go_by_longer_anchors(spark):
    rng = random.Random(14)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = [(i, f"{i:080d}" + passage[: 50 + i % 300] + f"{-i:080d}") for i in range(600)]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], KIND).repartition(4)
    for bound in (1 << 12, 1 << 14):
        assert suffix.overfull(suffix.keyed(frame), 100, 512, bound, 1)
        assert run(spark, rows, buckets=512, bound=bound, sample=1) == expected(ordered(spark, rows))


def test_previous_factors_of_a_suffix_array():
    rng = random.Random(5)
    for _ in range(30):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(40, 120)))
        length = 9
        starts = np.arange(len(text) - length + 1)
        rank = np.array(rng.sample(range(1000), len(starts)))
        data = np.frombuffer(text, np.uint8)
        order, common = suffix.sorted_suffixes(data, starts, np.zeros(len(starts), np.int64), rank, length)
        assert [text[i : i + length] for i in order] == sorted(text[i : i + length] for i in starts)
        factor = dict(zip(order, suffix.previous_factors(rank[order], common, length)))
        best = defaultdict(int)
        for i in starts:
            for j in starts:
                if rank[j] < rank[i]:
                    n = next((k for k in range(length) if text[i + k] != text[j + k]), length)
                    best[i] = max(best[i], n)
        assert all((factor[i] >= length) == (best[i] >= length) for i in starts)


def test_rows_with_one_checksum_keep_their_own_words(spark):
    """Two different texts of one CRC-32 and no id: only the copy loses words."""
    passage = " ".join(f"p{i}" for i in range(20))
    other = " ".join(f"q{i}" for i in range(20))

    rng = random.Random(6)

    def checksums(text):
        some = ("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(1 << 17))
        return {zlib.crc32(f"{text} {w}".encode()): w for w in some}

    left, right = checksums(passage), checksums(other)
    c = min(set(left) & set(right))
    rows = [(1, passage), (None, f"{passage} {left[c]}"), (None, f"{other} {right[c]}")]
    assert zlib.crc32(rows[1][1].encode()) == zlib.crc32(rows[2][1].encode())
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.without_repeats(frame).collect()
    assert Counter((r.n_words, r.n_removed) for r in found) == Counter({(20, 0): 1, (21, 20): 1, (21, 0): 1})
