"""The pipeline's stages against brute force, each on what the one before it kept."""

from collections import Counter

import cases
import pytest

import corpus_pipeline
from quern.session import materialize

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["data", "awkward", "empty"])
def stages(request, spark, tmp_path_factory):
    folder = DATA
    if request.param != "data":
        rows = cases.AWKWARD if request.param == "awkward" else []
        folder = cases.write(tmp_path_factory.mktemp(request.param), rows=rows)
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, folder), name)
        out.append((docs, after))
        docs = after
    return folder, out


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_columns_stay_until_the_last_stage(stages):
    _, out = stages
    for before, after in out[:-1]:
        assert after.columns == before.columns


def test_language_stage_keeps_texts_with_letters(stages):
    before, after = stages[1][0]
    kept = Counter(texts(after))
    assert not kept - Counter(texts(before))
    gone = Counter(texts(before)) - kept
    assert all(not any(c.isalpha() for c in t or "") for _, t in gone)


def test_one_document_of_each_class_stays(stages):
    before, after = stages[1][1]
    rows = [{"doc_id": i, "text": t} for i, t in texts(before)]
    expected = {(i, c) for i, _, c in cases.near_classes(rows, 5, 80) if i == c}
    assert {i for i, _ in texts(after)} == {i for i, _ in expected}
    assert max(Counter(texts(after)).values(), default=1) == 1


def test_near_dedup_tells_rows_without_own_id_apart(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    rows = [
        (None, "a row without an id"), (None, "another row without an id"), (None, one), (10, one),
        (10, one), (None, one + " end"), (2, two), (5, two), (5, "text of its own"),
        (None, three), (None, three + " end"), (None, three), (8, None), (8, ""), (None, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter(texts(corpus_pipeline.drop_near_duplicates(spark, docs, "")))
    either = [(None, three), (None, three + " end")]
    assert sum(found.pop(x, 0) for x in either) == 1
    assert found == Counter([*rows[:2], (10, one), (2, two), (5, "text of its own"), *rows[-3:]])


def test_no_test_item_stays(stages):
    folder, out = stages
    before, after = out[2]
    items = [b["text"].lower() for b in cases.read(folder, "benchmark") if b["text"]]
    leak = {(i, t) for i, t in texts(before) if any(x in (t or "").lower() for x in items)}
    assert Counter(texts(after)) == Counter(x for x in texts(before) if x not in leak)


def test_mix_takes_words_of_its_input(stages):
    before, after = stages[1][3]
    whole = {}
    for i, t in texts(before):
        whole.setdefault(i, []).append(cases.words(t))
    taken = Counter()
    for i, t in texts(after):
        part = cases.words(t)
        assert any(set(part) <= set(w) for w in whole[i])
        taken[i] += len(part)
    assert all(n <= 2 * sum(map(len, whole[i])) for i, n in taken.items())
    total = sum(len(w) for ws in whole.values() for w in ws)
    if total:
        assert abs(sum(taken.values()) / total - 1.5) < 0.15


@pytest.mark.parametrize("long", [False, True])
def test_mix_sends_no_blocks_through_the_driver(spark, long):
    """A list of two sources is small; the blocks it asks for, or a long text has, are not."""
    n = 1 if long else 1500
    text = " ".join(f"w{i}" for i in range(100_000 if long else 60))
    rows = [(i, f"{text} {s}{i}", "en", s, 0) for i in range(n) for s in "ab"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.mix_sources(spark, materialize(docs, "docs"), "")
    found = mixed.collect()
    sizes = Counter({s: n * len(cases.words(f"{text} end")) for s in "ab"})
    taken = Counter()
    for r in found:
        taken[r.source] += len(cases.words(r.text))
    assert abs(taken["a"] - 2 * sizes["a"]) <= 128  # weighs 3 and is taken twice at most
    assert abs(taken["b"] - sizes["b"]) <= 128  # the rest of 150 %
    used = sum(sizes.values()) * 1.5 / 128
    assert max(cases.broadcast_rows(mixed), default=0) < used / 2


def test_every_mixed_row_has_a_place(stages):
    before, after = stages[1][4]
    assert Counter((i, cases.crc(t)) for i, t in texts(before)) == Counter(
        (r.doc_id, r.text_crc32) for r in after.collect()
    )
    assert Counter(texts(after)) == Counter(texts(before))  # the shards hold the texts
    assert all(r.text_crc32 == cases.crc(r.text) for r in after.collect())
    slots = {}
    for r in after.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, DATA)
    assert {"doc_id", "text", "source", "shard", "slot"} <= set(found.columns)
    assert found.filter("text <> ''").count() == found.count() > 0


def test_a_corpus_without_languages_stays(spark):
    rows = [(1, "some words here", None), (2, None, None), (3, "12", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert corpus_pipeline.identify_languages(spark, docs, "").collect() == docs.collect()


def test_a_text_of_three_languages_stays(spark):
    rows = cases.read("/root/testdata/sf0.01")
    long = {}
    for r in rows:
        if len(r["text"] or "") > 1500 and r["lang"]:
            long.setdefault(r["lang"], r["text"][:700])
    parts = list(long.values())[:3]
    assert len(parts) == 3
    learned = [(r["doc_id"], r["text"], r["lang"]) for r in rows]
    docs = spark.createDataFrame(learned + [(-1, " ".join(parts), None), (-2, "?!", None)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.identify_languages(spark, docs, "").collect()}
    assert -1 in kept and -2 not in kept
