"""Encoding whole texts with a tokenizer file, a slice of rows at a time.

For a byte-level BPE without normalizer whose text is split by the usual pattern
(contractions, letters, digits, other signs, blanks), a piece of the split always
encodes to the same ids.  Texts of Latin script are then split by numpy, each new
piece is encoded once by the tokenizer's own model, and ids are gathered by piece.
Texts with other characters, or with the string of a special token, go through the
tokenizer as they are; so do all texts for any other kind of tokenizer.

Pieces are recognised by a 64-bit hash and their length.  The store of known pieces
is emptied when it reaches ``LIMIT``, which bounds a worker's memory.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import pyarrow as pa

from quern.llm import words as W

LIMIT = 3_000_000
SLICE = 2 << 20
#: Code points below this are split by numpy; they take one or two bytes.
LATIN = 0x250
_OTHER, _LETTER, _DIGIT, _BLANK = 0, 1, 2, 3
#: Code points below LATIN with the property White_Space (fixed values).
_BLANKS = {9, 10, 11, 12, 13, 32, 0x85, 0xA0}


def _classes() -> np.ndarray:
    kinds = np.zeros(LATIN, dtype=np.uint8)
    for cp in range(LATIN):
        category = unicodedata.category(chr(cp))
        if cp in _BLANKS:
            kinds[cp] = _BLANK
        elif category[0] == "L":
            kinds[cp] = _LETTER
        elif category[0] == "N":
            kinds[cp] = _DIGIT
    return kinds


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown}
    letters.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return letters


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def piece_starts(data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Byte positions where pieces begin, for rows of Latin text.

    Every row has at least one byte.
    """
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    cp = data[lead].astype(np.int32)
    two = np.flatnonzero(cp >= 0xC0)
    cp[two] = ((cp[two] & 31) << 6) | (data[lead[two] + 1] & 63)
    kind = kinds[cp]
    n = len(cp)
    opens = np.zeros(n + 1, dtype=bool)  # first of a row, and the place after all
    opens[np.searchsorted(lead, bounds)] = True
    cut = opens[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(cut)
    end = np.r_[start[1:], n]
    k = kind[start]
    begins = np.zeros(n + 1, dtype=bool)
    begins[start] = True
    # Blanks before other characters: the last one stands apart, and a space joins them.
    inner = (k == _BLANK) & ~opens[end]
    last = end[inner] - 1
    begins[last] = True
    begins[end[inner][cp[last] == 32]] = False
    # A lone apostrophe that begins a piece takes s, t, m, d, re, ve or ll after it.
    mark = np.flatnonzero((k == _OTHER) & (end - start == 1) & (cp[start] == 39))
    mark = mark[(mark + 1 < len(start)) & begins[start[mark]]]
    mark = mark[~opens[end[mark]]]
    mark = mark[k[mark + 1] == _LETTER]
    if len(mark):
        at = start[mark + 1]
        run = end[mark + 1] - at
        one, second = cp[at], cp[np.minimum(at + 1, n - 1)]
        pair = (run > 1) & (
            (((one == ord("r")) | (one == ord("v"))) & (second == ord("e")))
            | ((one == ord("l")) & (second == ord("l")))
        )
        single = np.isin(one, [ord(c) for c in "stmd"])
        took = np.where(single, 1, np.where(pair, 2, 0))
        hit = took > 0
        begins[at[hit]] = False
        more = hit & (run > took)
        begins[at[more] + took[more]] = True
    return lead[np.flatnonzero(begins[:n])]


class Encoder:
    """Ids of texts, as one flat array with bounds per row."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        model = spec["model"]
        self.by_piece = (
            model["type"] == "BPE" and not spec.get("normalizer") and not model.get("dropout")
            and split.get("type") == "ByteLevel" and split.get("use_regex")
            and not split.get("add_prefix_space") and not model.get("ignore_merges")
        )
        self.special = [t["content"].encode() for t in spec.get("added_tokens") or ()]
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        self.kinds = _classes()
        self.letters = _byte_letters()
        self._lengths: np.ndarray | None = None
        self._empty()

    def byte_lengths(self) -> np.ndarray:
        """Bytes that each id of a byte-level vocabulary stands for."""
        if self._lengths is None:
            self._lengths = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
            for token, i in self.tokenizer.get_vocab().items():
                special = token.encode() in self.special
                self._lengths[i] = len(token.encode()) if special else len(token)
        return self._lengths

    def _empty(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        tokenize = self.tokenizer.model.tokenize
        raw, sizes, ids = data.tobytes(), [], []
        for x, y in zip(a.tolist(), b.tolist()):
            word = raw[x:y].decode("latin-1").translate(self.letters)
            found = [t.id for t in tokenize(word)]
            sizes.append(len(found))
            ids += found
        sizes = np.array(sizes, np.int64)
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.slot = np.insert(self.slot, place, len(self.sizes) + np.arange(len(hashes)))
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.sizes = np.concatenate([self.sizes, sizes])
        self.starts = np.concatenate([self.starts, starts])
        self.flat = np.concatenate([self.flat, np.array(ids, self.dtype)])

    def _latin(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of Latin text, none of them empty."""
        a = piece_starts(data, bounds, self.kinds)
        b = np.r_[a[1:], len(data)]
        h = W.mix(W.running(W._BYTE[data], a, b) + (b - a).astype(np.uint64))
        values, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(values) > LIMIT:
            self._empty()
        at = np.minimum(np.searchsorted(self.known, values), max(len(self.known) - 1, 0))
        new = self.known[at] != values if len(self.known) else np.ones(len(values), bool)
        if new.any():
            self._learn(values[new], data, a[first[new]], b[first[new]])
            at = np.searchsorted(self.known, values)
        slot = self.slot[at][inverse]
        sizes = self.sizes[slot]
        flat = self.flat[ragged(self.starts[slot], sizes)]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return flat, upto[np.searchsorted(a, bounds)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the bounds of each row's ids."""
        data, bounds = W.text_bytes(texts)
        n = len(texts)
        sizes = np.diff(bounds)
        plain = sizes > 0
        if self.by_piece and len(data):
            high = np.concatenate([[0], np.cumsum(data >= 0xC0 + (LATIN >> 6))])
            plain &= high[bounds[1:]] == high[bounds[:-1]]
            raw = data.tobytes()
            for token in self.special:
                at = raw.find(token)
                while at >= 0:
                    plain[np.searchsorted(bounds, at, "right") - 1] = False
                    at = raw.find(token, at + 1)
        else:
            plain[:] = False
        counts = np.zeros(n, np.int64)
        rows = np.flatnonzero(plain)
        if len(rows) == n and n:
            return self._latin(data, bounds)
        flat_plain = np.zeros(0, self.dtype)
        if len(rows):
            part = data[ragged(bounds[:-1][rows], sizes[rows])]
            flat_plain, upto = self._latin(part, np.concatenate([[0], np.cumsum(sizes[rows])]))
            counts[rows] = np.diff(upto)
        rest = np.flatnonzero(~plain & (sizes > 0))
        encoded = self.tokenizer.encode_batch(
            texts.take(pa.array(rest)).to_pylist(), add_special_tokens=False
        )
        counts[rest] = [len(e.ids) for e in encoded]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        flat = np.zeros(int(bounds[-1]), self.dtype)
        if len(rows):
            flat[ragged(bounds[:-1][rows], counts[rows])] = flat_plain
        for row, e in zip(rest, encoded):
            flat[bounds[row] : bounds[row + 1]] = e.ids
        return flat, bounds


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
