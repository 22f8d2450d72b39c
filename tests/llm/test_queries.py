"""Every query on the given tables, on awkward rows and on empty tables."""

import hashlib
import zlib
from collections import Counter

import cases
import numpy as np
import pytest
from oracle import connect, differences

from quern.llm import mixing, queries

DATA = "/root/testdata/sf0.001"


def by_prefix(op):
    return next(n for n in queries.ALL if n.startswith(f"op{op}_"))


def run(spark, op, folder):
    return queries.ALL[by_prefix(op)](spark, folder)


TURNS = [
    (1, 0, "system", "be\\brief <|im_end|>"), (1, 1, "user", None), (1, 2, "assistant", "a\nb <|x|>"),
    (1, 3, "assistant", ""), (1, 4, "user", "trailing"), (2, 0, "user", "no reply \\s \\| <\\|"),
    (None, 0, "assistant", "no id"), (3, None, "assistant", "no turn"), (3, 5, None, "no role"),
    (3, 5, None, "no role"), (4, 0, "odd\nrole<|im_start|>", "x" * 50_000), (4, 1, "assistant", "y é 日"),
]


@pytest.fixture(scope="module")
def awkward(tmp_path_factory):
    return cases.write(tmp_path_factory.mktemp("awkward"), turns=TURNS)


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    return cases.write(tmp_path_factory.mktemp("empty"), rows=[], items=[])


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    assert differences(queries.ALL[name](spark, DATA), connect(DATA), queries.SQL[name]) == []


@pytest.mark.parametrize("op", [1, 3, 4, 5, 6, 7, 8, 9, 10])
def test_empty_tables(spark, empty, op):
    assert run(spark, op, empty).count() == 0


def test_chat_of_an_empty_table_has_the_added_conversation(spark, empty):
    (row,) = run(spark, 2, empty).collect()
    text = "<|im_end|><|im_start|>assistant ok"
    assert (row.conv_id, row.n_turns, row.loss_chars) == (-1, 2, len(text))
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_near_duplicates(spark, awkward):
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in run(spark, 1, awkward).collect())
    assert found == cases.near_classes(cases.read(awkward), 3, 85)


def test_chat(spark, awkward):
    found = {r.conv_id: r for r in run(spark, 2, awkward).collect()}
    text = "<|im_end|><|im_start|>assistant ok"
    turns = TURNS + [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    assert set(found) == {t[0] for t in turns}
    for conv, row in found.items():
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
        whole = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        loss = "".join(x or "" for _, _, r, x in own if r == "assistant")
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_leaks(spark, awkward):
    found = run(spark, 3, awkward).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(60, 7), (60, 7)]
    assert all(r.score > 0.99 and r.question_overlap == r.answer_overlap == 1 for r in found)


def test_languages_of_awkward_rows(spark, awkward):
    rows = run(spark, 4, awkward).collect()
    assert len(rows) == len(cases.AWKWARD)
    unknown = Counter(r.doc_id for r in rows if r.lang_pred == "und")
    assert unknown == Counter({30: 1, 31: 1, 32: 1, 33: 1})
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in rows if r.held_out} == {
        i for i, *_ in cases.AWKWARD if i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    }


def test_languages_held_out_accuracy(spark):
    folder = DATA.replace("sf0.001", "sf0.01")
    rows = run(spark, 4, folder).collect()
    lang = {r["doc_id"]: r["lang"] for r in cases.read(folder)}
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == lang[r.doc_id] for r in held)
    assert len(held) > 200 and right / len(held) > 0.98


@pytest.mark.parametrize("given", ["awkward", "data"])
def test_shards(spark, awkward, given):
    folder = awkward if given == "awkward" else DATA
    docs, rows = cases.read(folder), run(spark, 5, folder).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d["doc_id"], len((d["text"] or "").encode()) + 1, cases.crc(d["text"])) for d in docs
    )
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(8)) and {r.law for r in rows} == {"bytes"}
    if given == "data":
        sizes = Counter()
        for r in rows:
            sizes[r.shard] += r.size
        largest = max(r.size for r in rows)
        assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def expected_targets(sizes, ratio=1.5):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, capped = ratio * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        free = sum(w for s, w in weight.items() if s not in capped)
        share = {s: 2.0 * sizes[s] if s in capped else rest * weight[s] / free for s in sizes}
        over = {s for s in sizes if s not in capped and share[s] > 2 * sizes[s]}
        if not over:
            return share
        capped |= over


@pytest.mark.parametrize("given", ["awkward", "data"])
def test_mix(spark, awkward, given):
    folder = awkward if given == "awkward" else DATA
    docs, frame = cases.read(folder), run(spark, 6, folder)
    rows = frame.collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter(
        (d["doc_id"], len(cases.words(d["text"]))) for d in docs
    )
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    sizes = Counter()
    for d in docs:
        sizes[d["source"]] += len(cases.words(d["text"]))
    goal = expected_targets(sizes)
    if given == "data":
        source = {d["doc_id"]: d["source"] for d in docs}
        taken = Counter()
        for r in rows:
            s = source[r.doc_id]
            assert r.source_size == sizes[s] and r.target == pytest.approx(goal[s])
            taken[s] += r.taken
        assert all(abs(taken[s] - goal[s]) <= 1.5 * mixing.BLOCK for s in sizes)
    else:
        assert {round(r.target, 6) for r in rows} == {round(x, 6) for x in goal.values()}
    assert Counter(map(tuple, rows)) == Counter(map(tuple, run(spark, 6, folder).collect()))


@pytest.mark.parametrize("n, length", [(2000, 100), (3, 100_000)])
def test_mix_sends_no_slots_through_the_driver(spark, tmp_path, n, length):
    text = " ".join(f"w{i}" for i in range(length))
    folder = cases.write(tmp_path, [(i, f"{text} {i}", "en", "ab"[i % 2]) for i in range(n)])
    mixed = run(spark, 6, folder)
    taken = sum(r.taken for r in mixed.collect())
    words = n * (length + 1)
    assert abs(taken - 1.5 * words) <= 2 * mixing.BLOCK
    # Sums by document may be broadcast where they turn out small; there are more slots.
    assert max(cases.broadcast_rows(mixed), default=0) <= n < taken / mixing.BLOCK


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.byte_bpe())


@pytest.mark.parametrize("given", ["awkward", "data"])
def test_token_files(spark, awkward, tokenizer, given):
    folder = awkward if given == "awkward" else DATA
    docs = cases.read(folder)
    encoded = tokenizer.encode_batch([d["text"] or "" for d in docs], add_special_tokens=False)
    ids = [np.array([*e.ids, 2], "<u4") for e in encoded]
    rows = sorted(run(spark, 7, folder).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter(
        (d["doc_id"], len(x), zlib.crc32(x.tobytes())) for d, x in zip(docs, ids)
    )
    assert [r.start for r in rows] == list(np.cumsum([0, *(r.n_tokens for r in rows)])[:-1])
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)


@pytest.mark.parametrize("given", ["awkward", "data"])
def test_section_tokens(spark, awkward, tokenizer, given):
    folder = awkward if given == "awkward" else DATA
    expected = Counter()
    for d in cases.read(folder):
        text = d["text"] or ""
        lines = [x + "\n" for x in text.split("\n")]
        lines[-1] = lines[-1][:-1]
        cuts = np.cumsum([0, *map(len, lines)])
        counts = [0] * len(lines)
        for a, b in tokenizer.encode(text, add_special_tokens=False).offsets:
            counts[int(np.argmax(np.minimum(b, cuts[1:]) - np.maximum(a, cuts[:-1])))] += 1
        for k, (line, n) in enumerate(zip(lines, counts)):
            expected[d["doc_id"], k, int(cuts[k]), len(line), n] += 1
    found = run(spark, 8, folder).collect()
    assert Counter((r.doc_id, r.section, r.start, r.n_chars, r.n_tokens) for r in found) == expected


def test_repeated_windows(spark, awkward):
    found = Counter(map(tuple, run(spark, 9, awkward).collect()))
    assert found == cases.without_repeats(cases.read(awkward))


def test_exact_groups(spark, awkward):
    docs = cases.read(awkward)
    groups = {}
    for d in docs:
        groups.setdefault((d["text"] or "").translate(cases.LOWER), []).append(d["doc_id"])
    rows = run(spark, 10, awkward).collect()
    expected = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            expected[i, keep, len(ids), digest] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
