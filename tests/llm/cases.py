"""Small tables with awkward rows, and plain Python versions of the operators."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
LONG = " ".join(f"w{i * i % 9973}" for i in range(30_000))
ITEM = "Which river flows through the old town of Elmbridge? The quiet Wexmere flows there"

#: (doc_id, text, lang, source)
AWKWARD = [
    (10, BASE, "en", "b"),
    (11, BASE.upper(), "en", "b"),
    (12, BASE + " seventeen", "en", "b"),
    (3, "pre " + BASE + " post words that only this one has", "en", None),
    (10, BASE, "en", "b"),  # a repeated row
    (20, "same id", "en", "a"),
    (20, "other text of the same id", "en", "a"),
    (None, "a row without an id", "en", "a"),
    (None, BASE, None, "a"),
    (30, None, "en", "c"),
    (31, "", None, None),
    (32, " \n\t ", "en", "c"),
    (33, "!!! 123", "en", "c"),
    (40, LONG, "en", "a"),
    (41, LONG + " tail", "en", "a"),
    (50, "Ünïcödé ñandú été <|endoftext|> x", "fr", "d"),
    (51, "日本語 の テキスト don't  stop\n\n'tis", "ja", "d"),
    (52, "a", "en", "d"),
    (53, "A", "en", "d"),
    (54, "a b", "en", "d"),
    (60, "so they asked: " + ITEM + ", and went on", "en", "e"),
    (61, "\x00 nul and \x1c separators \x0b here", "en", "e"),
]

EXTRA = ["node", "component", "token", "text_hash", "slot", "shard", "start", "lang_pred", "score", "spans", "entry", "k"]


def documents(rows=AWKWARD) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    table = {
        "doc_id": pa.array(columns[0], pa.int64()), "text": pa.array(columns[1], pa.string()),
        "lang": pa.array(columns[2], pa.string()), "source": pa.array(columns[3], pa.string()),
        "n_chars": pa.array([len(t or "") for t in columns[1]], pa.int64()),
    }
    for name in EXTRA:
        table[name] = pa.array(["x"] * len(rows), pa.string())
    return pa.table(table)


def write(folder, rows=AWKWARD, items=((7, ITEM), (7, ITEM), (8, None), (9, "")), turns=()) -> str:
    pq.write_table(documents(rows), f"{folder}/documents.parquet")
    bench = pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": pa.array([t for _, t in items], pa.string())})
    pq.write_table(bench, f"{folder}/benchmark.parquet")
    columns = list(zip(*turns)) if turns else [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["conv_id", "turn", "role", "text"]
    table = {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}
    table["written"] = pa.array(["x"] * len(turns), pa.string())
    pq.write_table(pa.table(table), f"{folder}/conversations.parquet")
    return str(folder)


def read(folder, name="documents"):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def words(text):
    return WORD.findall(text or "")


def near_classes(rows, width, percent):
    """Expected (doc_id, n_shingles, component_id) of each row."""
    sets = []
    for r in rows:
        w = words((r["text"] or "").translate(LOWER))
        n = max(1, len(w) - width + 1)
        sets.append({tuple(w[i : i + width]) for i in range(n)} if w else set())
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                label[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r["doc_id"])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return Counter((r["doc_id"], len(sets[i]), least[find(i)]) for i, r in enumerate(rows))


def without_repeats(rows, window=13):
    """Expected (doc_id, n_words, n_removed, digest) of each row."""
    big = 1 << 62
    starts = defaultdict(lambda: big)
    for r in rows:
        w, doc = words(r["text"]), big if r["doc_id"] is None else r["doc_id"]
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            starts[key] = min(starts[key], doc)
    out = Counter()
    for r in rows:
        w, doc = words(r["text"]), big if r["doc_id"] is None else r["doc_id"]
        stays = [True] * len(w)
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] < doc:
                stays[i : i + window] = [False] * window
        kept = " ".join(x for x, s in zip(w, stays) if s)
        out[r["doc_id"], len(w), stays.count(False), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


def broadcast_rows(frame):
    """Rows of each broadcast of a frame that has run."""
    found, left = [], [frame._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        elif kind == "BroadcastExchangeExec":
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found
