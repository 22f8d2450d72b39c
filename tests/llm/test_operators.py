"""Operators with small limits, so that every path for large inputs is taken."""

import random
import re
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm import (
    chat, decontamination, exact_dedup, graph, language_id, mixing, near_dedup, queries,
    sharding, substring_dedup, token_counts, token_files,
)
from quern.llm import words as W
from quern.llm.shipping import ship
from quern.llm.tokenizing import Encoder

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def near_copies(seed=3, groups=3, size=30, words=120):
    """Documents in groups whose members differ by some changed words."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(10_000)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(5)):
                own[rng.randrange(words)] = f"x{rng.randrange(1_000_000)}"
            rows.append((len(rows), " ".join(own), "en", "s"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("limits", [{}, {"short_list": 3, "block_members": 8, "block_shingles": 1500}])
def test_near_duplicates_in_blocks(spark, limits):
    rows = near_copies()
    found = near_dedup.near_duplicates(frame(spark, rows), width=3, percent=85, **limits)
    expected = cases.near_classes([{"doc_id": i, "text": t} for i, t, *_ in rows], 3, 85)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == expected


def test_families_beyond_a_block(spark, monkeypatch):
    """Large groups travel about twice, and no link is lost."""
    rng = random.Random(21)
    rows = near_copies(seed=4, groups=1, size=150, words=100)
    # A second family that only a chain of copies links to the first one.
    base = rows[0][1].split()
    for step in range(12):
        for k in range(9):
            base[(step * 9 + k) % 100] = f"y{step}z{k}"
        rows.append((len(rows), " ".join(base[:100]), "en", "s"))
        rows.append((len(rows), " ".join([*base[:99], "z"]), "en", "s"))
    rng.shuffle(rows)
    loaded = []
    real = near_dedup.links_in_groups

    def counted(members, group, weight, limit, load, compare):
        def count(frame):
            out = load(frame)
            loaded.append((group, out.count()))
            return out

        return real(members, group, weight, limit, count, compare)

    monkeypatch.setattr(near_dedup, "links_in_groups", counted)
    found = near_dedup.near_duplicates(
        frame(spark, rows), width=3, percent=70, block_members=40, block_shingles=1500
    )
    expected = cases.near_classes([{"doc_id": i, "text": t} for i, t, *_ in rows], 3, 70)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == expected
    copies = sum(n for group, n in loaded if group == "component")
    assert copies < 5 * len(rows)  # eleven blocks; every two of them would be 12 times


def test_least_matches_bounds_the_misses():
    from math import comb

    for percent in (80, 85):
        t = near_dedup.least_matches(128, percent, 1e-8)
        p = percent / 100
        below = sum(comb(128, i) * p**i * (1 - p) ** (128 - i) for i in range(t))
        assert below <= 1e-8 < below + comb(128, t) * p**t * (1 - p) ** (128 - t)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    edges += [(5000, 5001 + i) for i in range(300)] + [(4000 + i, 5000 + i) for i in range(9)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            label[max(a, b)] = min(a, b)
    for hot in (None, 1, 3):  # nodes with more edges are looked up apart
        found = graph.components(spark.createDataFrame(edges, "a long, b long"), hot)
        assert {r.node: r.component for r in found.collect()} == {x: find(x) for x in label}


def test_words_and_shingles():
    texts = pa.array(["", "a", "a b", " A  b\tc d\x1ce ", "é ü", cases.LONG], pa.large_string())
    words = W.split(texts, lower=True)
    assert words.counts.tolist() == [len(cases.words(t)) for t in texts.to_pylist()]
    h, bounds = W.shingles(words, 3)
    for i, text in enumerate(texts.to_pylist()):
        w = cases.words(text.translate(cases.LOWER))
        grams = {tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set()
        assert len(set(h[bounds[i] : bounds[i + 1]].tolist())) == len(grams)


def test_repeated_windows_of_shared_passages(spark, monkeypatch):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(80):
        own = [f"o{rng.randrange(10**9)}" for _ in range(rng.randrange(40))]
        part = passage[rng.randrange(20) : 30 + rng.randrange(30)]
        rows.append((i, " ".join(own + part * rng.randrange(3) + own[:5])))
    found = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    got = Counter(
        (r.doc_id, r.n_words, r.n_removed, r.d)
        for r in found.withColumn("d", F.sha2("kept_text", 256)).collect()
    )
    assert got == cases.without_repeats([{"doc_id": i, "text": t} for i, t in rows])


def test_buckets_of_frequent_minimisers_are_dealt_by_window(spark):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(1200):
        before, after = ([f"o{rng.randrange(10**9)}" for _ in range(25)] for _ in range(2))
        rows.append((i, " ".join(before + passage * (i % 3 == 0) + after)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    limit, packs = 1 << 13, {}
    for bound in (1 << 40, limit):
        size = Counter()
        for r in substring_dedup.dealt(docs, 13, 3, 1024, bound, sample=1).filter("not decided").collect():
            size[r.bucket] += len(substring_dedup.Strings.unpack(r.packed).data)
        packs[bound] = max(size.values())
    assert packs[1 << 40] > 3 * limit > packs[limit]
    spans = substring_dedup.repeated_spans(docs, 13, 3, 1024, limit, sample=1).collect()
    gone = defaultdict(set)
    for r in spans:
        gone[r.doc].update(range(r.start, r.end))
    expected = {i: n for i, _, n, _ in cases.without_repeats([{"doc_id": i, "text": t} for i, t in rows]) if n}
    assert len(expected) == 399 and {i: len(x) for i, x in gone.items()} == expected


def test_windows_under_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(W, "mix", lambda h: h * np.uint64(0))
    texts = pa.array(["a b c", "a b d", "a b c"], pa.large_string())
    words = W.split(texts)
    groups = substring_dedup._same_windows(words, words.first[:-1], 3)
    assert groups[0] == groups[2] != groups[1]


def test_directory_doubles_until_no_bucket_is_overfull():
    sizes = np.zeros(64, np.int64)
    sizes[[3, 4, 5, 40]] = 10, 10, 10, 500
    directory, depth, buckets = exact_dedup.grow_directory(sizes, 15)
    assert len(directory) == 1 << depth and sorted(set(directory)) == list(range(len(buckets)))
    assert (np.diff(directory) >= 0).all()
    load = np.bincount(np.repeat(directory, 64 >> depth), weights=sizes)
    for number, (local, _) in enumerate(buckets):
        assert load[number] <= 15 or local == 6  # one prefix holds more than a bucket


def test_exact_groups_with_small_buckets(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["Copy", "copy", f"t{i % 50}", f"Own {i}"])) for i in range(400)]
    found = exact_dedup.exact_groups(
        spark.createDataFrame(rows, "doc_id long, text string"), bits=6, capacity=200, owners=5
    ).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t.lower()].append(i)
    text = dict(rows)
    assert len(found) == 400
    for r in found:
        own = groups[text[r.doc_id].lower()]
        assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))


def test_batches_are_looked_up_and_inserted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_HOT", 2)
    rng = random.Random(12)
    index = exact_dedup.ExactIndex(spark, str(tmp_path / "index"), bits=6, capacity=2000)
    known, depths = {}, []
    for number in range(3):
        rows = [(number * 1000 + i, rng.choice(["Hot", "hot", f"t{rng.randrange(300)}"])) for i in range(200)]
        rows += [(None, "no id"), (number * 1000 + 999, None)]
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        found = Counter((r.doc_id, r.keep_id, r.group_size) for r in index.lookup(frame).collect())
        expected = Counter()
        for i, t in rows:
            ids = known.get((t or "").lower(), [])
            expected[i, max((x for x in ids if x is not None), default=None), len(ids)] += 1
        assert found == expected
        index.insert(frame)
        for i, t in rows:
            known.setdefault((t or "").lower(), []).append(i)
        depths.append(index.directory().select("bucket").distinct().count())
    assert depths == sorted(depths) and depths[-1] > depths[0]


def test_a_text_of_many_slices_is_one_row(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_HOT", 2)
    rows = [(i, "the same text " * 3 if i % 3 else f"own {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(30)
    entries = exact_dedup.page_entries(docs)
    (hot,) = exact_dedup.distinct_entries(entries).filter("entries > 1").collect()
    assert (hot.n, hot.top) == (2000, 2999) and hot.entries >= 30
    found = exact_dedup.exact_groups(docs).filter("group_size > 1").collect()
    assert {(r.keep_id, r.group_size) for r in found} == {(2999, 2000)} and len(found) == 2000
    assert [r.doc_id for r in found if r.kept] == [2999]


def test_colliding_hashes_are_chained(spark, monkeypatch):
    batch = pa.RecordBatch.from_pydict(
        {"hash": [1, 1, 1], "text": ["x", "y", "x"], "entry": [0, 1, 2], "top": [5, 6, 7], "n": [1, 2, 3]}
    )
    rows = [r for out in exact_dedup._own(iter([batch])) for r in out.to_pylist()]
    assert {(r["entry"], r["keep_id"], r["group_size"], r["holds"]) for r in rows} == {
        (0, 7, 4, False), (2, 7, 4, True), (1, 6, 2, True)
    }


def test_rebalancing_moves_little_and_balances(spark):
    rng = random.Random(6)
    loads = spark.createDataFrame(
        [(v, rng.randrange(1, 1000), 1) for v in range(512) if v % 7], "vslot long, bytes long, rows long"
    )
    first = sharding.first_map(spark, 4, 512)
    second = sharding.rebalance(first, loads, 4)
    rows = {r.vslot: r for r in second.collect()}
    assert len(rows) == 512 and {r.version for r in rows.values()} == {2}
    size = Counter()
    for r in rows.values():
        size[r.shard] += r.bytes
    fair = sum(size.values()) / 4
    assert all(abs(x - fair) <= 1000 for x in size.values())
    third = {r.vslot: r for r in sharding.rebalance(second.select("version", "vslot", "shard"), loads, 5).collect()}
    grown = Counter()
    for r in third.values():
        grown[r.shard] += r.bytes
    assert all(abs(x - sum(grown.values()) / 5) <= 1000 for x in grown.values())
    moved = sum(r.bytes for v, r in third.items() if r.shard != rows[v].shard)
    assert moved <= grown[4] + 2 * 1000


def test_a_stored_map_is_edited(spark):
    rows = [(i % 40 if i % 3 else None, f"text {i}", "mine", "other") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, vslot string, extra string")
    placed, first = sharding.place(docs, 4, slots=64)
    assert placed.columns == ["doc_id", "text", "extra", "size", "text_crc32", "vslot", "shard", "slot"]
    assert sorted(r.version for r in first.select("version").distinct().collect()) == [1, 2]
    # Rows without an id spread over the shards.
    alone = Counter(r.shard for r in placed.filter("doc_id IS NULL").collect())
    assert len(alone) == 4 and max(alone.values()) < 120
    grown, second = sharding.place(docs, 5, slots=64, placement=first)
    assert first.exceptAll(second).isEmpty() and second.count() == 3 * 64
    old = {(r.doc_id, r.text): r for r in placed.collect()}
    moved = size = 0
    for r in grown.collect():
        assert r.vslot == old[r.doc_id, r.text].vslot
        size += r.size
        moved += r.size * (r.shard != old[r.doc_id, r.text].shard)
    assert moved < 0.35 * size
    again, third = sharding.place(docs, 5, slots=64, placement=second)
    same = {(r.doc_id, r.text): r.shard for r in grown.collect()}
    assert sum(r.size * (same[r.doc_id, r.text] != r.shard) for r in again.collect()) < 0.15 * size
    assert sorted(r.version for r in third.select("version").distinct().collect()) == [1, 2, 3, 4]


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 1000):
        image = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("x"))
        assert sorted(r.x for r in image.collect()) == list(range(n))


def test_mixed_documents_hold_the_taken_words(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    mixed = mixing.mixed_documents(docs, mixing.alternating(), block=16)
    assert mixed.columns == docs.columns
    text = {r.doc_id: r.text for r in docs.collect()}
    placed, _, slots = mixing.mix(docs, mixing.alternating(), block=16)
    taken = {
        (r.doc_id): r.n for r in mixing.taken_pieces(placed, slots, 16)
        .groupBy("doc_id").agg(F.sum("words").alias("n")).collect()
    }
    got = Counter()
    for r in mixed.collect():
        own, part = cases.words(text[r.doc_id]), cases.words(r.text)
        got[r.doc_id] += len(part)
        rest = iter(own)
        assert all(w in rest for w in part) and r.n_chars == len(r.text)
    assert got == Counter(taken)


def test_blocks_of_the_mix(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.unionByName(docs.limit(20))  # repeated rows have words of their own
    placed, quotas, slots = mixing.mix(docs, mixing.alternating(), block=16)
    found = mixing.blocks(docs, placed, slots, 16).collect()
    assert len(found) == slots.count() == len({(r.shard, r.position) for r in found})
    last = {r.source: r.blocks - 1 for r in quotas.collect()}
    text = {r.doc_id: cases.words(r.text) for r in docs.collect()}
    taken = Counter()
    for r in found:
        assert len(r.words) == 16 or r.block == last[r.source]
        parts = [w for p in r.parts for w in text[p.doc_id][p.first : p.first + p.words]]
        assert parts == r.words
        for p in r.parts:
            taken[p.doc_id] += p.words
    expected = mixing.taken_pieces(placed, slots, 16).groupBy("doc_id").agg(F.sum("words").alias("n"))
    assert taken == Counter({r.doc_id: r.n for r in expected.collect()})


def test_multinomial_counts_vary_by_shard_and_meet_quotas(spark):
    quotas = spark.createDataFrame([("a", 5000), ("b", 3000), (None, 2000)], "source string, slots long")
    rows = mixing.draw_slots(quotas, 3, 100).collect()
    assert len({(r.shard, r.position) for r in rows}) == 10_000
    total, per_shard = Counter(r.source for r in rows), Counter((r.shard, r.source) for r in rows)
    assert total == {"a": 5000, "b": 3000, None: 2000}
    counts = np.array([per_shard[s, "a"] for s in range(100)])
    assert 3 < counts.std() < 7  # a draw of 100 at one half has a deviation of 5


def test_wand_finds_what_full_scoring_finds():
    rng = np.random.default_rng(1)
    rows = [
        {"item_id": i, "words": rng.zipf(1.4, rng.integers(3, 40)).clip(max=400).tolist(), "question_words": 2}
        for i in range(300)
    ]
    for r in rows:
        terms = sorted(set(r["words"]))
        weights = rng.random(len(terms))
        r["postings"] = [
            {"term": t, "impact": w} for t, w in zip(terms, weights / weights.sum())
        ]
    index = decontamination.Index.build(rows)
    for threshold in (0.1, 0.4, 0.8):
        queries = [np.unique(rng.integers(0, len(index.terms), rng.integers(1, 60))) for _ in range(30)]
        number = np.repeat(np.arange(30), [len(q) for q in queries])
        found = defaultdict(dict)
        for q, item, value in zip(*decontamination.wand(index, number, np.concatenate(queries), threshold)):
            found[q][item] = value
        for q, query in enumerate(queries):
            score = np.zeros(300)
            for t in query:
                span = slice(index.starts[t], index.starts[t + 1])
                score[index.items[span]] += index.impacts[span]
            assert set(found[q]) == set(np.flatnonzero(score >= threshold - 1e-9).tolist())
            assert all(abs(v - score[i]) < 1e-9 for i, v in found[q].items())


def test_leaks_with_the_index_in_blocks(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    whole = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, bench).collect()}
    parts = decontamination.find_leaks(docs, bench, index_words=500)
    assert whole == {(r.doc_id, r.item_id) for r in parts.collect()}
    held = {
        (d["doc_id"], b["item_id"]) for d in cases.read(DATA) for b in cases.read(DATA, "benchmark")
        if b["text"].lower() in d["text"].lower()
    }
    assert held and held <= whole


def test_answers():
    item = "What is it? A thing."
    assert item[decontamination.answer_start(item) :] == "A thing."
    for text in ("One. Two three.", "a b c d", "Only a question?  ", ""):
        assert decontamination.answer_start(text) == 0
    assert [decontamination.shingle_width(n) for n in (1, 5, 6, 14, 15)] == [1, 1, 2, 2, 5]


def plain_leaks(docs, items, threshold=0.4, overlap=0.5):
    """Every passage against every item, in plain Python."""
    def split(text):
        return re.findall("[0-9A-Za-z\x80-\U0010ffff]+", (text or "").lower())

    def runs(words, n):
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    def share(passage, part):
        n = decontamination.shingle_width(len(part))
        return len(runs(part, n) & runs(passage, n)) / len(runs(part, n))

    parsed = []
    for i, text in items:
        cut = decontamination.answer_start(text or "")
        words, q = split(text), len(split((text or "")[:cut]))
        if words:
            parsed.append((i, words, (words[:q], words[q:]) if q else (words, words)))
    n, mean = len(parsed), np.mean([len(w) for _, w, _ in parsed])
    df = Counter(t for _, w, _ in parsed for t in set(w))
    length = max(len(w) for _, w, _ in parsed)
    weights = []
    for _, words, _ in parsed:
        own = {}
        for t, tf in Counter(words).items():
            idf = np.log1p((n - df[t] + 0.5) / (df[t] + 0.5))
            own[t] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
        weights.append({t: w / sum(own.values()) for t, w in own.items()})
    found = set()
    for doc, text in docs:
        words = split(text)
        for at in range(0, max(1, len(words) - length), length) if words else ():
            passage = words[at : at + 2 * length]
            have = set(passage)
            for (i, _, parts), own in zip(parsed, weights):
                if sum(w for t, w in own.items() if t in have) >= threshold - 1e-9:
                    if min(share(passage, x) for x in parts) >= overlap:
                        found.add((doc, i))
    return found


def test_leaks_equal_plain_search(spark):
    """Whole, edited and cut items, with and without questions, inside other texts."""
    rng = random.Random(11)
    some = [r["text"] for r in cases.read(DATA)[:30]]
    items = [(b["item_id"], b["text"]) for b in cases.read(DATA, "benchmark")]
    items += [(1000 + i, f"What is the name of {t.split('.')[0][:80]}? {rng.choice(['Blue', 'It is the old harbour bridge'])} {i}") for i, t in enumerate(some[:6])]
    docs, planted = list(enumerate(some)), set()
    for kind in ("whole", "edited", "cut"):
        for i, text in items:
            words = text.split()
            if kind == "edited":
                for _ in range(max(1, len(words) // 20)):
                    words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            if kind == "cut" and i < 1000:
                words = words[: int(len(words) * 0.8)]
            doc = len(docs)
            docs.append((doc, " ".join([rng.choice(some)[:300], *words, rng.choice(some)[:300]])))
            planted.add((doc, i))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame, bench).collect()}
    assert found == plain_leaks(docs, items)
    recall = len(planted & found) / len(planted)
    print("recall of planted leaks", recall)
    assert recall >= 0.9


def test_mixture_of_two_languages(spark):
    rows = cases.read("/root/testdata/sf0.01")
    labelled = spark.createDataFrame(
        [(r["text"], r["lang"]) for r in rows], "text string, lang string"
    )
    model = language_id.Model.learn(labelled)
    en = next(r["text"] for r in rows if r["lang"] == "en" and len(r["text"]) > 2000)[:1200]
    es = next(r["text"] for r in rows if r["lang"] == "es" and len(r["text"]) > 2000)[:800]
    row, slot = language_id.trigrams(pa.array([en, en + " " + es, es], pa.large_string()))
    found = language_id.infer(model, row, slot, 2.0)
    names = [[model.languages[k] for k in s] for s in found.sets]
    assert names == [["en"], ["en", "es"], ["es"]]
    assert 0.5 < found.shares[1][0] < 0.7 and abs(found.shares[1].sum() - 1) < 1e-9
    assert (found.evidence > 0).all()


def plain_mixture(log_p, slots, members, rounds=4000):
    pi = np.full(len(members), 1 / len(members))
    p = np.exp(log_p[slots][:, members].astype(float))
    for _ in range(rounds):
        joint = p * pi
        pi = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
    return pi, float(np.log(p @ pi).sum())


def test_mixtures_equal_plain_estimates():
    rng = np.random.default_rng(3)
    k = 7
    log_p = np.log(rng.dirichlet(np.full(60, 0.3), k).T + 1e-6).astype(np.float32)
    table = np.full((language_id.SLOTS, k), -12, np.float32)
    table[:60] = log_p
    model = language_id.Model([f"l{i}" for i in range(k)], table)
    texts, truth = [], []
    for _ in range(40):
        members = rng.choice(k, rng.integers(1, 7), replace=False)
        pi = rng.dirichlet(np.full(len(members), 5.0))
        q = np.exp(log_p[:, members].astype(float)) @ pi
        texts.append(rng.choice(60, 3000, p=q / q.sum()))
        truth.append(set(members.tolist()))
    row = np.repeat(np.arange(40), 3000)
    found = language_id.infer(model, row, np.concatenate(texts), 2.0)
    assert max(len(s) for s in found.sets) > 4  # no limit to the set
    for slots, own, share, members in zip(texts, found.sets, found.shares, truth):
        pi, _ = plain_mixture(table, slots, own)
        assert np.abs(pi - share).max() < 0.02
        full, _ = plain_mixture(table, slots, np.arange(k))
        order = np.argsort(-full, kind="stable")
        value, size = max(
            (plain_mixture(table, slots, order[:s])[1] - 2 * np.log(3000) * (s - 1), -s)
            for s in range(1, k + 1)
        )
        got = plain_mixture(table, slots, own)[1] - 2 * np.log(3000) * (len(own) - 1)
        assert got >= value - 1.0
        assert len(set(own.tolist()) & members) >= len(members) - 1


def test_no_evidence_for_noise(spark):
    rows = cases.read("/root/testdata/sf0.001")
    model = language_id.Model.learn(
        spark.createDataFrame([(r["text"], r["lang"]) for r in rows], "text string, lang string")
    )
    rng = random.Random(9)
    noise = "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(500))
    frame = spark.createDataFrame([(rows[0]["text"], "x"), (noise, "x"), (None, "x"), ("12", "x")], "text string, languages string")
    found = language_id.identify(frame, model).collect()
    assert found[0].evidence > 1 and found[1].evidence <= 0
    assert [(r.lang_pred, r.score, r.languages, r.evidence) for r in found[2:]] == [("und", 0.0, [], 0.0)] * 2


def test_many_languages(spark):
    rows = [(f"{chr(0x4E00 + i)}{chr(0x5E00 + i)} " * 30, f"lang{i:03d}") for i in range(150)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    found = language_id.identify(frame, language_id.Model.learn(frame)).collect()
    assert all(r.lang_pred == r.lang for r in found)


def test_escapes_are_reversible(spark):
    texts = ["\\", "\\s", "\\|", "<|", "<\\|", "<|im_end|>", "a\nb", "\\n", "<<||", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    out = frame.select(
        "t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")
    ).collect()
    assert all(r.u == r.t and "<|" not in r.e for r in out)


def test_encoder_equals_the_tokenizer():
    encode = Encoder(queries.byte_bpe())
    rng = random.Random(1)
    pool = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "''", "'S", "'x", " ", "  ", "\n", " \n",
            "\t", "\u0085", " ", "1", "²", "½", "a", "é", "ñ", "ʰ", ".", "<|endoftext|>", "<|", "r", "ll"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(14))) for _ in range(3000)]
    for cp in range(0x260):
        texts += [chr(cp), f"x{chr(cp)}{chr(cp)} {chr(cp)} y", f"a {chr(cp)}s'{chr(cp)}"]
    flat, bounds = encode.encode(pa.array(texts, pa.large_string()))
    expected = encode.tokenizer.encode_batch(texts, add_special_tokens=False)
    for k, e in enumerate(expected):
        assert flat[bounds[k] : bounds[k + 1]].tolist() == e.ids, repr(texts[k])


def test_crossing_tokens_go_to_the_larger_share():
    start, end = np.array([0, 3, 6, 8]), np.array([3, 6, 8, 12])
    section, crossing = token_counts.attribute(start, end, np.array([0, 4, 7, 7, 12]))
    assert section.tolist() == [0, 1, 1, 3] and crossing.tolist() == [False, True, True, False]


def test_tokens_of_fields(spark):
    rows = spark.createDataFrame([(1, "one two", None), (2, "", "three")], "doc_id long, title string, body string")
    found = token_counts.section_tokens(rows, queries.byte_bpe(), ("title", "body")).collect()
    assert sorted((r.doc_id, r.section, r.n_chars, r.n_tokens) for r in found) == [
        (1, 0, 8, 3), (1, 1, 0, 0), (2, 0, 1, 1), (2, 1, 5, 1)
    ]


def test_token_files_are_memory_mapped(spark):
    docs = spark.createDataFrame([(2, "b"), (1, "a a"), (None, "z")], "doc_id long, text string")
    folder, manifest = token_files.write_token_files(docs, queries.byte_bpe())
    ids = []
    for row in sorted(manifest.collect(), key=lambda r: r.tokens_base):
        assert len(ids) == row.tokens_base
        part = token_files.TokenPart(folder, row.part, row.width)
        assert isinstance(part.ids, np.memmap) and part.offsets[-1] == row.tokens
        ids += part.ids.tolist()
    encode = Encoder(queries.byte_bpe()).tokenizer.encode
    assert ids == [t for x in ("z", "a a", "b") for t in [*encode(x).ids, 2]]


def test_crc_is_unsigned():
    assert cases.crc("a") == zlib.crc32(b"a")
