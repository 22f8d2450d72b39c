"""MinHash near-duplicate classes by an inverted join over signature coordinates.

1. Every document becomes its set of distinct word shingles, a key of that set and
   a signature of ``coordinates`` minima.  Documents with equal sets are merged
   first, so copies, however many, count once.
2. Sets are posted under their (coordinate, value) pairs, batch by batch with counts,
   which gives the length of every posting list.  Two sets that agree in at least
   ``least`` coordinates share one of the first ``coordinates - least + 1`` pairs of
   each in any common order (prefix principle); ordered by length of list, pairs that
   no other set has come first and long lists last.  A set that shares fewer than
   ``least`` pairs with all others has no list to merge, and a set's longest lists are
   skipped.
3. Short lists give pairs of sets; collisions are counted over the whole signature
   and pairs below ``least`` are dropped.  Long lists are counted inside tasks,
   block against block, and give only a forest of the retained pairs.
4. Retained pairs form candidate components.  Inside each, similarities are computed
   on the full sets; pairs that are already connected need no check.

Components beyond ``block_shingles``, and long lists, are cut into blocks.  Each block is
linked inside itself, then with the first block, which is a sample of the group.  What is
not connected to the group's largest class by then, usually little, meets every block.
So the members of a family of copies travel twice or so, however large it is.

No list or component is capped.  ``least`` is chosen so that a pair at the threshold
falls below it with a probability under ``miss``.

Defined results: NULL and blank texts have no shingles and no links; rows that repeat
a doc_id are nodes of their own as far as their texts differ; a NULL doc_id takes part
and never is the smallest, unless a class has no other.  Columns besides ``doc_id``
and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import words as W
from quern.llm.graph import components
from quern.llm.key_filter import maybe_in
from quern.session import materialize

SHORT_LIST = 16
#: Node numbers with equal higher bits form a batch of up to 4096 sets.
BATCH_BITS = 12


@lru_cache
def least_matches(coordinates: int, percent: int, miss: float) -> int:
    """Largest t such that a pair at the threshold matches fewer than t times with
    a probability of at most ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(coordinates + 1):
        below += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


@lru_cache
def multipliers(coordinates: int) -> np.ndarray:
    rng = np.random.default_rng(7)
    return rng.integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(h: np.ndarray, bounds: np.ndarray, coordinates: int) -> np.ndarray:
    """Minima of each row that has shingles; zeros for others."""
    out = np.zeros((len(bounds) - 1, coordinates), dtype=np.uint32)
    full = np.diff(bounds) > 0
    if full.any():
        starts = bounds[:-1][full]
        for i, m in enumerate(multipliers(coordinates)):
            out[full, i] = np.minimum.reduceat(h * m, starts) >> np.uint64(32)
    return out


def fixed_binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    n, width = len(rows), rows.dtype.itemsize * rows.shape[1]
    offsets = np.arange(n + 1, dtype=np.int32) * width
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))]
    return pa.Array.from_buffers(pa.binary(), n, buffers)


def matrix(column: pa.Array | pa.ChunkedArray, dtype: type) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=dtype).reshape(len(values), -1)


def _set_keys(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128-bit keys of sorted sets."""
    starts, ends = bounds[:-1], bounds[1:]
    one = W.mix(W.running(sets, starts, ends))
    two = W.mix(W.running(W.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), starts, ends))
    size = np.diff(bounds).astype(np.uint64)
    return np.stack([one + size, two], axis=1)


def _describe(width: int, coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.text_column(batch, "text")
            ids, text_keys = batch.column("doc_id"), batch.column("text_key")
            for at, part in W.slices(texts):
                h, bounds = W.shingles(W.split(part, lower=True), width)
                sets, bounds = W.distinct_within(h, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, len(part)),
                        text_keys.slice(at, len(part)),
                        pa.array(np.diff(bounds)),
                        fixed_binary(_set_keys(sets, bounds)),
                        fixed_binary(signatures(sets, bounds, coordinates)),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "signature"],
                )
            W.give_back()

    return run


def _tokens(signature: np.ndarray) -> np.ndarray:
    """One 64-bit token per (coordinate, value); equal tokens are equal pairs."""
    place = np.arange(signature.shape[1], dtype=np.uint64) << np.uint64(32)
    return signature.astype(np.uint64) | place


def _batch_tokens(table: pa.Table, buckets: int):
    """Distinct tokens of a batch of sets, dealt to buckets: values, bucket of each
    (ascending), number of sets with each, and the place of every set's tokens."""
    tokens = _tokens(matrix(table.column("signature"), np.uint32))
    values, place, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    bucket = (W.mix(values) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    moved = np.empty_like(order)
    moved[order] = np.arange(len(order))
    return tokens, values[order], bucket[order], counts[order], moved[place].reshape(tokens.shape)


def _packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=kind)


def _post(buckets: int):
    """Post a batch of sets under its tokens: one row per bucket with the batch's
    distinct tokens and their counts, so a token in many sets is posted once."""

    def run(table: pa.Table) -> pa.Table:
        _, values, bucket, counts, _ = _batch_tokens(table, buckets)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        spans = list(zip(cuts[:-1], cuts[1:]))
        batch = table.column("batch")[0].as_py()
        return pa.table(
            {
                "batch": pa.array([batch] * len(spans), pa.int64()),
                "bucket": pa.array(bucket[cuts[:-1]]),
                "tokens": pa.array([_packed(values[x:y]) for x, y in spans], pa.binary()),
                "counts": pa.array([_packed(counts[x:y].astype(np.uint32)) for x, y in spans], pa.binary()),
            }
        )

    return run


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of sets with each token over all batches, answered batch by batch."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    if not rows:
        return
    tokens = [_unpacked(r.pop("tokens"), np.uint64) for r in rows]
    counts = [_unpacked(r.pop("counts"), np.uint32) for r in rows]
    cuts = np.cumsum([0, *map(len, tokens)])
    values, place = np.unique(np.concatenate(tokens), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(counts), minlength=len(values))
    answer = total[place].astype(np.uint64)
    for k, r in enumerate(rows):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r["batch"]], pa.int64()), pa.array([r["bucket"]], pa.int64()),
                pa.array([_packed(answer[cuts[k] : cuts[k + 1]])], pa.binary()),
            ],
            names=["batch", "bucket", "totals"],
        )


def _prefix(least: int, buckets: int):
    """Prefix of each set: with s of its tokens shared with other sets, the rarest
    s - least + 1 of those.  The tokens it shares with none come first in the order
    and need no list; the longest lists are skipped."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, _, _, _, place = _batch_tokens(table, buckets)
        answers = answers.sort_by("bucket")
        totals = np.concatenate(
            [_unpacked(x, np.uint64) for x in answers.column("totals").to_pylist()]
        )[place]
        shared = totals > 1
        s = shared.sum(axis=1)
        rows = np.flatnonzero(s >= least)
        node = table.column("node").to_numpy()[rows]
        order = np.lexsort(
            (tokens[rows], np.where(shared[rows], totals[rows], np.uint64(1 << 62))), axis=1
        )
        keep = np.arange(tokens.shape[1]) < (s[rows] - least + 1)[:, None]
        posted = np.take_along_axis(tokens[rows], order, axis=1)[keep]
        return pa.table(
            {"token": posted.view(np.int64), "node": np.repeat(node, keep.sum(axis=1))}
        )

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the members of each short list; a task gets whole lists."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    token, node = (table.column(c).to_numpy() for c in ("token", "node"))
    sort = np.lexsort((node, token))
    token, node = token[sort], node[sort]
    start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    size = np.diff(np.r_[start, len(token)])
    for m in np.unique(size[size > 1]):
        # All lists of one length at once: a matrix of members.
        members = np.unique(node[start[size == m][:, None] + np.arange(m)], axis=0)
        i, j = np.triu_indices(m, 1)
        pair = np.unique(np.stack([members[:, i].ravel(), members[:, j].ravel()], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"]
        )


def _connect(n: int, compare, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest of a similarity graph on n nodes; ``compare(i)`` gives the similar ones.

    Nodes of the largest component so far never need comparing with each other, so
    only nodes outside it are compared with all.  Nodes with equal ``known`` labels are
    connected from the start.
    """
    _, first, code = np.unique(known, return_index=True, return_inverse=True)
    label = first[code]
    left, right = [], []
    done = np.zeros(n, dtype=bool)
    while True:
        sizes = np.bincount(label, minlength=n)
        main = int(sizes.argmax())
        todo = np.flatnonzero(~done & (label != main)) if sizes[main] > 1 else np.flatnonzero(~done)
        if not len(todo) or sizes[main] == n:
            break
        i = int(todo[0])
        done[i] = True
        near = compare(i)
        near = near[label[near] != label[i]]
        for j in near:
            x, y = label[i], label[j]
            if x != y:
                left.append(i)
                right.append(j)
                label[label == max(x, y)] = min(x, y)
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _long_list(least: int):
    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        signature = matrix(table.column("signature"), np.uint32)

        def compare(i: int) -> np.ndarray:
            return np.flatnonzero((signature == signature[i]).sum(axis=1) >= least)

        a, b = _connect(len(node), compare, table.column("label").to_numpy())
        return pa.table({"a": node[a], "b": node[b]})

    return run


def _verify(width: int, percent: int):
    """Exact links inside a candidate component (or two of its blocks)."""

    def run(table: pa.Table) -> pa.Table:
        node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
        keys = table.column("set_key").to_pylist()
        seen: set[int] = set()
        kept, known, sets = [], [], []
        texts = W.text_column(table, "text")
        for at, part in W.slices(texts):
            h, bounds = W.distinct_within(*W.shingles(W.split(part, lower=True), width))
            for k, key in enumerate(_set_keys(h, bounds)):
                row = at + k
                if node[row] not in seen and key.tobytes() == keys[row]:
                    seen.add(node[row])
                    kept.append(node[row])
                    known.append(label[row])
                    sets.append(h[bounds[k] : bounds[k + 1]])
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        values, codes = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        member = np.zeros(len(values), dtype=np.int64)

        def compare(i: int) -> np.ndarray:
            own = codes[starts[i] : starts[i] + sizes[i]]
            member[own] = 1
            both = np.add.reduceat(member[codes], starts)
            member[own] = 0
            near = 100 * both >= percent * (sizes + sizes[i] - both)
            near[i] = False
            return np.flatnonzero(near)

        a, b = _connect(len(kept), compare, np.array(known, dtype=np.int64))
        kept = np.array(kept, dtype=np.int64)
        return pa.table({"a": kept[a], "b": kept[b]})

    return run


_PAIRS = "a long, b long"


def links_in_groups(
    members: DataFrame, group: str, weight: str, limit: int, load: Callable[[DataFrame], DataFrame],
    compare: Callable[[pa.Table], pa.Table],
) -> DataFrame:
    """Forest of links (``a``, ``b``) among the members of each group.

    ``members`` has ``node``, the group and a weight; ``load`` adds what ``compare`` needs
    to link the rows of a task, which also have ``label``, equal for nodes that are known
    to be connected.  A group above ``limit`` in weight is cut into blocks by a hash.
    """
    totals = members.groupBy(group).agg(F.sum(weight).alias("__total"))
    cut = materialize(
        totals.withColumn("blocks", F.ceil(F.col("__total") / F.lit(limit)).cast("int"))
        .filter("blocks > 1").select(group, "blocks"),
        "large-groups",
    )
    large = not cut.isEmpty()
    block = F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).cast("int")
    dealt = members.join(cut, group, "left").withColumn("block", block)

    def found(rows: DataFrame, name: str) -> DataFrame:
        met = load(rows).groupBy(group, "one", "other").applyInArrow(compare, _PAIRS)
        return materialize(met, name)

    inside = dealt.withColumns({"one": F.col("block"), "other": F.col("block"), "label": F.col("node")})
    links = found(inside, "links-inside")
    if not large:
        return links
    dealt = materialize(dealt.filter("blocks > 1"), "large-members")

    def labelled() -> DataFrame:
        classes = components(links).select(F.col("node").alias("__node"), F.col("component").alias("__class"))
        return dealt.join(classes, F.col("node") == F.col("__node"), "left").withColumn(
            "label", F.coalesce("__class", "node")
        ).drop("__node", "__class")

    # The first block, a sample of the group, meets each of the others.
    others = F.when(F.col("block") == 0, F.sequence(F.lit(1), F.col("blocks") - 1)).otherwise(F.array("block"))
    sample = labelled().withColumns({"one": F.lit(0), "other": F.explode(others)})
    links = links.unionByName(found(sample, "links-sample"))
    # What is outside the largest class of its group meets every block.
    known = materialize(labelled(), "large-labels")
    sizes = known.groupBy(group, "label").agg(F.sum(weight).alias("__size"))
    main = sizes.groupBy(group).agg(F.max_by("label", F.struct("__size", "label")).alias("main"))
    marked = known.join(main, group).withColumn("rest", F.col("label") != F.col("main"))
    left = marked.filter("rest").groupBy(group).agg(F.sum(weight).alias("__rest"))
    parts = left.select(group, F.ceil(F.col("__rest") / F.lit(limit)).cast("int").alias("parts"))
    marked = marked.join(parts, group)
    every = marked.withColumn("one", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn(
        "other", F.col("block")
    )
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
    elsewhere = (
        marked.filter("rest").withColumn("one", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .filter("other <> block")
    )
    return links.unionByName(found(every.unionByName(elsewhere), "links-rest"))


def _row_key(doc_id: str, text_key) -> Column:
    """One number for doc_id, NULL among them, and text hash."""
    return F.xxhash64(doc_id, F.col(doc_id).isNull(), text_key)


def near_duplicates(
    documents: DataFrame,
    width: int = 5,
    percent: int = 80,
    coordinates: int = 128,
    miss: float = 1e-8,
    short_list: int = SHORT_LIST,
    block_members: int = 8192,
    block_shingles: int = 3_000_000,
) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``set_key``, ``component_id`` and
    ``component_key`` of every document.

    Documents are linked when 100 * |A & B| >= percent * |A | B| on their shingle
    sets; ``component_id`` is the smallest doc_id reachable over links, and
    ``component_key`` the smallest ``text_key`` (a hash of the text) of its rows, so
    both name one document of each class even where doc_ids are NULL or repeated.
    """
    spark = documents.sparkSession
    least = least_matches(coordinates, percent, miss)
    text_key = F.xxhash64("text")  # with doc_id, finds a text again
    described = materialize(
        documents.select("doc_id", text_key.alias("text_key"), "text").mapInArrow(
            _describe(width, coordinates),
            "doc_id long, text_key long, n_shingles long, set_key binary, signature binary",
        ),
        "sets",
    )
    # Equal sets are merged; their copies combine before the shuffle.
    nodes = materialize(
        described.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("one"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(tasks, nodes.count() * coordinates // 2_000_000)
    in_batches = nodes.select(
        F.shiftright("node", BATCH_BITS).alias("batch"), "node", "signature"
    ).groupBy("batch")
    answers = (
        in_batches.applyInArrow(
            _post(buckets), "batch long, bucket long, tokens binary, counts binary"
        )
        .repartition(buckets, "bucket")
        .mapInArrow(_total, "batch long, bucket long, totals binary")
    )
    posted = materialize(
        in_batches.cogroup(answers.groupBy("batch")).applyInArrow(
            _prefix(least, buckets), "token long, node long"
        ),
        "postings",
    )
    lengths = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lists = posted.join(lengths, "token")
    signature = nodes.select("node", "signature")
    pairs = (
        lists.filter(F.col("n") <= short_list).select("token", "node")
        .repartition("token").mapInArrow(_pairs, "a long, b long").distinct()
    )
    same = F.transform(
        F.sequence(F.lit(0), F.lit(coordinates - 1)),
        lambda i: F.substring("sa", 4 * i + 1, F.lit(4)) == F.substring("sb", 4 * i + 1, F.lit(4)),
    )
    matches = F.size(F.filter(same, lambda x: x))
    retained = (
        pairs.join(signature.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
        .join(signature.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
        .filter(matches >= least)
        .select("a", "b")
    )
    long_lists = links_in_groups(
        lists.filter(F.col("n") > short_list).select("token", "node", F.lit(1).alias("weight")),
        "token", "weight", block_members,
        lambda rows: rows.join(signature, "node"), _long_list(least),
    )
    candidates = components(retained.unionByName(long_lists))
    members = materialize(
        nodes.select(
            "node", F.col("one.doc_id").alias("doc_id"), F.col("one.text_key").alias("text_key"),
            "set_key", "n_shingles",
        ).join(candidates, "node"),
        "candidates",
    )
    # Only texts of candidates travel, however many candidates there are; of rows that
    # repeat id and text one does, and copies combine before the shuffle.
    members = members.withColumn("row_key", _row_key("doc_id", "text_key"))
    texts = (
        maybe_in(
            documents.select(
                _row_key("doc_id", text_key).alias("row_key"), F.col("text").alias("text")
            ),
            members, ["row_key"], "__candidate",
        )
        .filter("__candidate").groupBy("row_key").agg(F.any_value("text").alias("text"))
    )
    links = links_in_groups(
        members.select("component", "node", "n_shingles", "row_key", "set_key"),
        "component", "n_shingles", block_shingles,
        lambda rows: rows.join(texts, "row_key"), _verify(width, percent),
    )
    classes = components(links)
    labelled = nodes.select("node", "set_key", "one").join(classes, "node")
    smallest = labelled.groupBy("component").agg(F.min("one").alias("linked"))
    linked = labelled.join(smallest, "component").select("set_key", "linked")
    by_set = nodes.select("set_key", F.col("one").alias("same")).join(
        linked, "set_key", "left"
    ).select("set_key", F.coalesce("linked", "same").alias("least"))
    alone = F.col("least").isNull()  # no shingles
    return described.drop("signature").join(by_set, "set_key", "left").select(
        "doc_id", "text_key", "n_shingles", "set_key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        F.when(alone, F.col("text_key")).otherwise(F.col("least.text_key")).alias("component_key"),
    )
