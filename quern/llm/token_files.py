"""Token ids as flat binary files with 64-bit document offsets.

Documents are range-partitioned and sorted by doc_id.  Each task encodes its texts and
writes two files: ``<part>.ids``, unsigned little-endian integers (16 bits when the
vocabulary fits, else 32), and ``<part>.docs``: the number of documents n, then n + 1
offsets into the ids, n doc_ids, all as 64-bit integers, and n bytes that are 1 where
the doc_id is NULL.  A manifest (one row per part) holds the bases, which are prefix
sums of the parts' sizes, so that every document has a place in the whole sequence.

A task that runs again writes files of another name; the manifest, which is stored
before anything reads it, names the files that count.  Files are read through memory
maps where the folder is a local or mounted one, and through its file system otherwise.

Defined results: NULL text is empty and has only the end id; NULL doc_ids come first;
rows that repeat a doc_id follow each other, ordered by the hash of their text; an
empty table has an empty manifest; columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm import words as W
from quern.llm.tokenizing import SLICE, encoder
from quern.session import materialize, shared_folder

_ROWS = 4096


def local_path(folder: str) -> str | None:
    """The path of a folder that is mounted here, or None."""
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    return None if "://" in folder else folder


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    path = local_path(folder)
    return (fs.LocalFileSystem(), path) if path else fs.FileSystem.from_uri(folder)


def _write(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        system, path = file_system(folder)
        number = TaskContext.get().partitionId()
        part = f"part-{number:06d}-{uuid.uuid4().hex[:12]}"
        out, sizes, ids, nulls = None, [], [], []
        for batch in batches:
            doc = batch.column("doc_id")
            nulls.append(np.asarray(doc.is_null()).astype(np.uint8))
            ids.append(doc.fill_null(0).to_numpy(zero_copy_only=False))
            for _, texts in W.slices(W.text_column(batch, "text"), SLICE):
                flat, bounds = encode.encode(texts)
                counts = np.diff(bounds)
                kind = flat.dtype if end_id <= np.iinfo(flat.dtype).max else np.uint32
                whole = np.full(len(flat) + len(counts), end_id, dtype=kind)
                ends = bounds[1:] + np.arange(len(counts))
                stays = np.ones(len(whole), dtype=bool)
                stays[ends] = False
                whole[stays] = flat
                if out is None:
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{part}.ids")
                out.write(whole.tobytes())
                width = whole.dtype.itemsize
                sizes.append(counts + 1)
        if out is None:
            return
        out.close()
        sizes = np.concatenate(sizes)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        with system.open_output_stream(f"{path}/{part}.docs") as docs:
            docs.write(np.array([len(sizes)], np.int64).tobytes())
            docs.write(offsets.astype(np.int64).tobytes())
            docs.write(np.concatenate(ids).astype(np.int64).tobytes())
            docs.write(np.concatenate(nulls).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([part]), pa.array([width], pa.int32()),
                pa.array([len(sizes)], pa.int64()), pa.array([int(offsets[-1])], pa.int64()),
            ],
            names=["number", "part", "width", "docs", "tokens"],
        )

    return run


def write_token_files(
    documents: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None
) -> tuple[str, DataFrame]:
    """Write all documents; returns the folder and the stored manifest."""
    folder = folder or shared_folder(documents.sparkSession, "tokens")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie")
    )
    parts = (
        rows.repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .mapInArrow(
            _write(folder, tokenizer, end_id),
            "number long, part string, width int, docs long, tokens long",
        )
    )
    stored = materialize(parts, "token-parts")
    # One row per part: the window over them is small.
    before = Window.partitionBy(F.lit(0)).orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    manifest = stored.select(
        *stored.columns,
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_base"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_base"),
    )
    return folder, materialize(manifest, "token-manifest")


class TokenPart:
    """One part, memory-mapped: ``ids[offsets[i]:offsets[i + 1]]`` are document i's."""

    def __init__(self, folder: str, part: str, width: int):
        kind = np.dtype(f"<u{width}")
        path = local_path(folder)
        if path:
            self.ids = np.memmap(f"{path}/{part}.ids", dtype=kind, mode="r")
            docs = np.memmap(f"{path}/{part}.docs", dtype=np.uint8, mode="r")
        else:
            system, path = fs.FileSystem.from_uri(folder)
            with system.open_input_file(f"{path}/{part}.ids") as f:
                self.ids = np.frombuffer(f.read(), dtype=kind)
            with system.open_input_file(f"{path}/{part}.docs") as f:
                docs = np.frombuffer(f.read(), dtype=np.uint8)
        n = int(docs[:8].view(np.int64)[0])
        self.offsets = docs[8 : 8 * (n + 2)].view(np.int64)
        self.doc_ids = docs[8 * (n + 2) : 8 * (2 * n + 2)].view(np.int64)
        self.no_id = docs[8 * (2 * n + 2) :].astype(bool)


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = TokenPart(folder, row["part"], row["width"])
                n = len(part.doc_ids)
                for at in range(0, n, _ROWS):
                    end = min(at + _ROWS, n)
                    offsets = part.offsets[at : end + 1]
                    sums = [
                        zlib.crc32(part.ids[a:b].astype("<u4").tobytes())
                        for a, b in zip(offsets[:-1], offsets[1:])
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(part.doc_ids[at:end]), mask=part.no_id[at:end]),
                            pa.array(offsets[:-1] + row["tokens_base"]),
                            pa.array(np.diff(offsets)),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return run


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document."""
    parts = manifest.select("part", "width", "tokens_base")
    tasks = max(1, min(parts.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return parts.repartition(tasks, "part").mapInArrow(
        _read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
