"""Language identification by multilingual mixture inference.

Model: per language, the frequencies of letter trigrams (a letter with its neighbours,
in lower case, a blank standing for anything that is no letter), counted over all
training texts and hashed into ``SLOTS`` slots.

Inference: a document's trigrams are taken as draws from a mixture of languages.
Expectation-maximisation estimates the proportions, until the likelihood no longer
rises; candidate sets are the best single language and the leading languages of the
full mixture, one more at a time as long as the likelihood less a penalty per further
language rises.  The selected set and its proportions are returned; the largest one
gives the language and the score.  ``evidence`` is what the mixture explains better, in
nats a letter, than trigrams drawn at random; no known language gives 0 or less.

A model takes 128 KB per language on every worker; texts are worked on in slices that
are the smaller the more languages there are.

Defined results: a text that is NULL or has no letter is ``und`` with score 0 and an
empty set; so is every text when nothing was learned; NULL languages and texts teach
nothing; ties go to the language that comes first by name; texts of any length count
with all their letters.  Columns of the input are passed through, except ``lang_pred``,
``score``, ``languages``, ``proportions`` and ``evidence``, which are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import words as W
from quern.session import materialize

SLOTS = 1 << 15
#: Languages whose counts a task holds before it hands them on.
HELD = 128
#: Distinct labels beyond which a model (512 MB) is refused: labels are not languages then.
MOST_LANGUAGES = 4096
#: Rounds end when they gain less than this, in nats for the whole document.
TOLERANCE = 1e-2
UNKNOWN = "und"
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letters
    if _letters is None:
        kinds = map(unicodedata.category, map(chr, range(0x110000)))
        _letters = np.fromiter((k[0] == "L" for k in kinds), bool, 0x110000)
    return _letters


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and slot of every letter's trigram."""
    joined = "\n".join(t.replace("\n", " ") for t in texts.to_pylist()).lower()
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.cumsum(points == 10)
    letter = letter_table()[points]
    kept = np.concatenate([[0], np.where(letter, points, 0), [0]]).astype(np.uint64)
    code = (kept[:-2] << np.uint64(42)) | (kept[1:-1] << np.uint64(21)) | kept[2:]
    slot = (W.mix(code[letter]) % np.uint64(SLOTS)).astype(np.int64)
    return row[letter], slot


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language, summed over a task."""
    held: dict[str, np.ndarray] = {}

    def give() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            slot = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(counts[slot])],
                names=["lang", "slot", "n"],
            )
        held.clear()

    for batch in batches:
        texts, langs = W.text_column(batch, "text"), batch.column("lang")
        for at, part in W.slices(texts):
            row, slot = trigrams(part)
            own = langs.slice(at, len(part)).dictionary_encode()
            names, codes = own.dictionary.to_pylist(), own.indices.to_numpy()
            counts = np.bincount(codes[row] * SLOTS + slot, minlength=len(names) * SLOTS)
            for k, name in enumerate(names):
                mine = counts[k * SLOTS : (k + 1) * SLOTS]
                if name in held:
                    held[name] += mine
                else:
                    held[name] = mine.astype(np.int64)
            if len(held) > HELD:
                yield from give()
    yield from give()


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # slot by language

    @staticmethod
    def learn(labelled: DataFrame) -> Model:
        """Count all texts of ``text``, ``lang``; at most MOST_LANGUAGES * SLOTS sums
        reach the driver."""
        sums = materialize(
            labelled.filter("lang is not null and text is not null").select("text", "lang")
            .mapInArrow(_count, "lang string, slot long, n long")
            .groupBy("lang", "slot").agg(F.sum("n").alias("n")),
            "trigrams",
        )
        languages = sorted(
            r["lang"] for r in sums.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()
        )
        if len(languages) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
        counts = np.zeros((SLOTS, len(languages)))
        rows = sums.toArrow()
        lang = pc.index_in(rows["lang"], pa.array(languages, pa.string())).to_numpy()
        counts[rows["slot"].to_numpy(), lang] = rows["n"].to_numpy()
        counts += 0.5
        log_p = np.log(counts / counts.sum(axis=0)) if languages else counts
        return Model(languages, log_p.astype(np.float32))


@dataclass
class Mixtures:
    """Per row with letters: the selected languages by proportion, largest first."""

    row: np.ndarray
    sets: list[np.ndarray]
    shares: list[np.ndarray]
    evidence: np.ndarray


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(sizes) - sizes, axis=0)


def estimate(p: np.ndarray, weight: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihoods of mixtures, by expectation-maximisation.

    Document after document has ``sizes`` rows of ``p``, the probabilities of a trigram
    in each language, with their ``weight``.  A document leaves the rounds when its
    likelihood gains less than TOLERANCE; it rises in every round and is bounded.
    """
    n, k = len(sizes), p.shape[1]
    total = _sums(weight, sizes)
    shares, value = np.full((n, k), 1.0 / k), np.full(n, -np.inf)
    active = np.arange(n)
    while len(active):
        pi = shares[active]
        joint = p * np.repeat(pi, sizes, axis=0)
        mass = joint.sum(axis=1)
        now = _sums(np.log(mass) * weight, sizes)
        joint *= (weight / mass)[:, None]
        shares[active] = _sums(joint, sizes) / total[:, None]
        goes_on = now - value[active] >= TOLERANCE
        value[active] = now
        if not goes_on.all():
            rows = np.repeat(goes_on, sizes)
            p, weight = p[rows], weight[rows]
            active, sizes, total = active[goes_on], sizes[goes_on], total[goes_on]
    return shares, value


def infer(model: Model, row: np.ndarray, slot: np.ndarray, penalty: float) -> Mixtures:
    """The mixture of each row with letters; ``row`` ascends.

    Equal trigrams of a row are merged and weighted.
    """
    key, n = np.unique(row * SLOTS + slot, return_counts=True)
    row, slot = key // SLOTS, key % SLOTS
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    sizes = np.diff(np.r_[starts, len(row)])
    log_p = model.log_p[slot].astype(np.float64)
    weight = n.astype(float)
    total = _sums(weight, sizes)
    single = _sums(log_p * weight[:, None], sizes)
    docs, languages = np.arange(len(starts)), log_p.shape[1]
    best = single.argmax(axis=1)
    value = fit = single[docs, best]
    sets = [np.array([k]) for k in best]
    shares = [np.ones(1) for _ in docs]
    if languages > 1:
        cost = penalty * np.log(np.maximum(total, 2))
        top = log_p.max(axis=1)
        p = np.exp(log_p - top[:, None])
        base = _sums(top * weight, sizes)
        order = np.argsort(-estimate(p, weight, sizes)[0], axis=1, kind="stable")
        open_, fit = docs, fit.copy()
        value = value.copy()
        for size in range(2, languages + 1):
            rows = np.repeat(np.isin(docs, open_), sizes)
            chosen = order[open_, :size]
            own = np.take_along_axis(p[rows], np.repeat(chosen, sizes[open_], axis=0), axis=1)
            pi, found = estimate(own, weight[rows], sizes[open_])
            found += base[open_]
            penalised = found - cost[open_] * (size - 1)
            better = penalised > value[open_]
            for at in np.flatnonzero(better):
                doc = open_[at]
                by = np.lexsort((chosen[at], -pi[at]))
                sets[doc], shares[doc] = chosen[at][by], pi[at][by]
            kept = open_[better]
            value[kept], fit[kept] = penalised[better], found[better]
            open_ = kept
            if not len(open_):
                break
    return Mixtures(row[starts], sets, shares, fit / total + np.log(SLOTS))


_ADDED = {
    "lang_pred": T.StringType(), "score": T.DoubleType(),
    "languages": T.ArrayType(T.StringType()), "proportions": T.ArrayType(T.DoubleType()),
    "evidence": T.DoubleType(),
}


def _identify(model: Model, penalty: float):
    size = max(1 << 14, min(1 << 19, (1 << 23) // max(len(model.languages), 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            texts = W.text_column(batch, "text")
            n = len(texts)
            sets: list = [[]] * n
            shares: list = [[]] * n
            evidence = np.zeros(n)
            for at, part in W.slices(texts, size):
                row, slot = trigrams(part)
                if len(row) and model.languages:
                    found = infer(model, row, slot, penalty)
                    evidence[at + found.row] = found.evidence
                    for r, own, pi in zip(at + found.row, found.sets, found.shares):
                        sets[r], shares[r] = names[own], pi
            first = [s[0] if len(s) else UNKNOWN for s in sets]
            score = [min(1.0, float(pi[0])) if len(pi) else 0.0 for pi in shares]
            kept = [c for c in batch.schema.names if c not in _ADDED]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept), pa.array(first, pa.string()), pa.array(score),
                    pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64())),
                    pa.array(evidence),
                ],
                names=[*kept, *_ADDED],
            )
            W.give_back()

    return run


def identify(documents: DataFrame, model: Model, penalty: float = 2.0) -> DataFrame:
    """Add ``lang_pred``, ``score`` (its proportion), ``languages`` and ``proportions`` of the
    mixture, and ``evidence``, to documents with a ``text``.

    ``penalty`` times the log of the number of letters is the price of each further
    language in the set.
    """
    kept = [f for f in documents.schema if f.name not in _ADDED]
    added = [T.StructField(name, kind) for name, kind in _ADDED.items()]
    return documents.mapInArrow(_identify(model, penalty), T.StructType([*kept, *added]))


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Documents that teach nothing: CRC-32 of the id's text leaves 2 modulo 4."""
    crc = F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8"))
    return F.coalesce(crc % 4 == 2, F.lit(False))
