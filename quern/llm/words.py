"""Words, hashes and shingles of whole Arrow batches, computed with numpy.

A word is a maximal run of bytes other than the six ASCII blanks (tab to carriage
return, and space).  These bytes never occur inside a longer UTF-8 sequence, so
splitting bytes and splitting characters agree.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ORDER = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, 1, …, n - 1 modulo 2 ** 64; kept for lengths of ordinary slices."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = max(n, SLICE_BYTES)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if size <= 2 * SLICE_BYTES:
            _powers[int(base)] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def running(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end) of 64-bit values: sums of value * step ** i."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(_STEP, n), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(_STEP_INVERSE, n + 1)[starts]


@dataclass
class Words:
    """Words of a slice: byte spans in ``data``, the row of each, and row bounds."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # first word of each row, and one more entry for the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A hash of each word's bytes; long slices are worked on in parts."""
        n = len(self.starts)
        out = np.empty(n, dtype=np.uint64)
        at = 0
        while at < n:
            begin = int(self.starts[at])
            end = max(at + 1, int(np.searchsorted(self.ends, begin + SLICE_BYTES, "right")))
            part = _BYTE[self.data[begin : self.ends[end - 1]]]
            out[at:end] = running(part, self.starts[at:end] - begin, self.ends[at:end] - begin)
            at = end
        return mix(out)


def give_back() -> None:
    """Return freed memory to the system; worker processes live on after a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library; it keeps what it likes


def text_column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    column = batch.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its rows in them."""
    _, offsets, data = texts.buffers()
    n = len(texts)
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Cut an array into runs of rows with at most ``limit`` bytes (or one row)."""
    n = len(texts)
    if not n:
        return
    _, bounds = text_bytes(texts)
    at = 0
    while at < n:
        end = int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, texts.slice(at, end - at)
        at = end


def blanks(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A to Z become a to z; every other byte stays."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def split(texts: pa.Array, lower: bool = False) -> Words:
    data, bounds = text_bytes(texts)
    if lower:
        data = lower_ascii(data)
    return split_bytes(data, bounds)


def split_bytes(
    data: np.ndarray, bounds: np.ndarray, blank: np.ndarray | None = None
) -> Words:
    """Words of rows of bytes; ``blank`` marks other separators than blanks."""
    n = len(data)
    if blank is None:
        blank = blanks(data)
    cut = np.ones(n + 1, dtype=bool)  # before each byte: blank or a new row
    cut[1:n] = blank[:-1]
    cut[bounds] = True
    starts = np.flatnonzero(~blank & cut[:-1])
    cut[:n] |= blank
    ends = np.flatnonzero(~blank & cut[1:]) + 1
    first = np.searchsorted(starts, bounds)
    return Words(data, starts, ends, first)


def terms(texts: pa.Array) -> Words:
    """Search terms: runs of ASCII letters, digits and non-ASCII bytes, in lower case
    (A to Z, and the letters from U+00C0 to U+00DE)."""
    data, bounds = text_bytes(texts)
    data = lower_ascii(data)
    after = np.zeros(len(data), dtype=bool)
    after[1:] = data[:-1] == 0xC3
    latin = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    data = np.where(latin, data + np.uint8(32), data)
    word = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    return split_bytes(data, bounds, ~word)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of ``width`` words, with repeats, and row bounds.

    A row with fewer words has its whole sequence as its only shingle; a row
    without words has none.
    """
    h, counts, first = words.hashes(), words.counts, words.first
    n = len(h)
    starts = np.arange(n)
    rows = words.rows()
    left = first[1:][rows] - starts  # words from here to the end of the row
    keep = left >= width
    short = (counts < width) & (counts > 0)
    keep[first[:-1][short]] = True
    span = np.minimum(left, width)[keep]
    total = np.zeros(len(span), dtype=np.uint64)
    picked = starts[keep]
    for i in range(width):
        inside = span > i
        if inside.all():
            total += h[picked + i] * _ORDER[i]
        else:
            total[inside] += h[picked[inside] + i] * _ORDER[i]
    per_row = np.where(counts >= width, counts - width + 1, short.astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    return mix(total + span.astype(np.uint64)), bounds


def distinct_within(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row."""
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    out = np.concatenate(parts) if parts else values[:0]
    return out, np.concatenate([[0], np.cumsum(sizes)])
