"""Token counts per section by offset-mapped attribution.

A document is encoded once, as a whole; the spans of its tokens are then joined to the
spans of its sections, both in order, so that counts add up to the document's own.

Rule for a token that crosses a boundary: it belongs whole to the section that holds
most of its characters, and of equal shares to the earlier one.  ``crossing`` counts
such tokens where they were put.  A token that holds a part of a character's bytes
spans that character.

Defined results: NULL is empty; an empty document has one empty section without
tokens; NULL or repeated doc_ids stay rows of their own; an empty table gives an empty
result; columns besides ``doc_id`` and the fields are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import words as W
from quern.llm.tokenizing import SLICE, encoder, ragged

_OUT = "doc_id long, section int, start long, n_chars long, n_tokens long, crossing long"


def token_spans(encode, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character spans of all tokens, over the joined characters of all rows, and the
    bounds of each row's tokens."""
    data, bounds = W.text_bytes(texts)
    lead = (data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(lead)])
    if encode.by_piece:
        # The bytes of a byte-level token are as many as the letters that write it.
        flat, upto = encode.encode(texts)
        ends = np.cumsum(encode.byte_lengths()[flat])
        starts = ends - encode.byte_lengths()[flat]
        return chars[starts + 1] - 1, chars[ends], upto
    encoded = encode.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
    upto = np.concatenate([[0], np.cumsum([len(e.ids) for e in encoded])]).astype(np.int64)
    base = np.repeat(chars[bounds[:-1]], np.diff(upto))
    spans = [np.array(e.offsets, np.int64).reshape(-1, 2) for e in encoded]
    spans = np.concatenate(spans) if spans else np.zeros((0, 2), np.int64)
    return base + spans[:, 0], base + spans[:, 1], upto


def attribute(
    start: np.ndarray, end: np.ndarray, cuts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token and whether it crosses a boundary.

    Tokens are spans [start, end) in order; section k is [cuts[k], cuts[k + 1]).
    """
    first = np.searchsorted(cuts, start, "right") - 1
    last = np.maximum(np.searchsorted(cuts, end - 1, "right") - 1, first)
    crossing = last > first
    section = first.copy()
    x = np.flatnonzero(crossing)
    if len(x):
        n = last[x] - first[x] + 1
        token = np.repeat(x, n)
        candidate = ragged(first[x], n)
        share = np.minimum(end[token], cuts[candidate + 1]) - np.maximum(start[token], cuts[candidate])
        # Largest share first, then the earlier section.
        order = np.lexsort((candidate, -share, token))
        section[x] = candidate[order][np.cumsum(n) - n]
    return section, crossing


def line_lengths(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Characters of each line and lines per row; a newline belongs to the line it ends."""
    data, bounds = W.text_bytes(texts)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(bounds, breaks, "right") - 1
    at = np.concatenate([bounds[:-1], breaks + 1])
    order = np.lexsort((at, np.concatenate([np.arange(len(texts)), row])))
    sizes = np.diff(np.append(chars[at[order]], chars[-1]))
    return sizes, 1 + np.bincount(row, minlength=len(texts))


def _count(tokenizer: str, by_line: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            texts = W.text_column(batch, "text")
            ids = batch.column("doc_id")
            for at, part in W.slices(texts, SLICE):
                if by_line:
                    sizes, per_row = line_lengths(part)
                else:
                    own = batch.column("lengths").slice(at, len(part))
                    sizes = own.flatten().to_numpy().astype(np.int64)
                    per_row = own.value_lengths().to_numpy()
                cuts = np.concatenate([[0], np.cumsum(sizes)])
                opens = np.concatenate([[0], np.cumsum(per_row)])
                start, end, upto = token_spans(encode, part)
                row = np.repeat(np.arange(len(part)), np.diff(upto))
                # Empty sections own no character; a search from the right skips them.
                section, crossing = attribute(start, end, cuts)
                section = np.clip(section, opens[row], opens[row + 1] - 1)
                total = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(at, len(part)).take(pa.array(np.repeat(np.arange(len(part)), per_row))),
                        pa.array(ragged(np.zeros(len(part), np.int64), per_row).astype(np.int32)),
                        pa.array(cuts[:-1] - np.repeat(cuts[opens[:-1]], per_row)),
                        pa.array(sizes),
                        pa.array(np.bincount(section, minlength=total)),
                        pa.array(np.bincount(section[crossing], minlength=total)),
                    ],
                    names=["doc_id", "section", "start", "n_chars", "n_tokens", "crossing"],
                )

    return run


def section_tokens(
    documents: DataFrame, tokenizer: str, fields: tuple[str, ...] = ("text",)
) -> DataFrame:
    """Tokens per section: ``doc_id``, ``section``, ``start``, ``n_chars``,
    ``n_tokens``, ``crossing``.

    The lines of a single field are its sections.  Of several fields, which are joined
    by a newline before they are encoded, each is a section with the newline after it.
    """
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.concat_ws("\n", *parts).alias("text")]
    if len(parts) > 1:
        lengths = [F.char_length(p) + (1 if p is not parts[-1] else 0) for p in parts]
        columns.append(F.array(*lengths).alias("lengths"))
    return documents.select(*columns).mapInArrow(_count(tokenizer, len(parts) == 1), _OUT)
