"""Token-id files: Simple-8b words with escapes, per-block offsets and a document table.

File layout, all integers little-endian::

    data       u64 x n_words    Simple-8b words, block after block
    offsets    u64 x n_blocks+1 first word of each block of ``block_ids`` ids
    escapes    u64 x 2 x n_escapes  (position of the id in the file, its value)
    doc ids    i64 x n_docs
    doc known  u8  x n_docs     0 where the doc id is null
    lengths    u64 x n_docs     ids of each document, end id included
    footer     u64 x 7          n_words, n_blocks, n_escapes, n_docs, n_ids, block_ids, MAGIC

The top four bits of a word select how many ids of which width fill its lower 60 bits.
A value that does not fit below 2**60 - 1 is written as the escape 2**60 - 1, and its
value stands in the escape table; so every word explains itself and whole runs of blocks
are decoded by array operations.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import materialise, read_table, scratch_path
from .tokens import default_path, word_encoder

#: Simple-8b's fixed table: ids per word and bits per id of each selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
ESCAPE = (1 << 60) - 1
MAGIC = int.from_bytes(b"TFS8B\0\0\1", "little")
BLOCK_IDS = 256
FOOTER_BYTES = 56
CHUNK_IDS = 1 << 18


def pack(values: np.ndarray, block_ids: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block (and the end), positions and values of escapes.

    Each block is packed greedily: every word takes the selector that holds most of the next ids.
    """
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        none = np.zeros(0, np.uint64)
        return none, np.zeros(1, np.uint64), none, none
    escaped = np.flatnonzero(values >= ESCAPE)
    escape_values = values[escaped]
    if len(escaped):
        values = values.copy()
        values[escaped] = ESCAPE
    top = int(values.max())
    small = values.astype(np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)
    index = np.arange(n, dtype=np.int32)
    room = np.minimum(block_ids - index % block_ids, n - index).astype(np.int32)
    # The greatest of the next 1, 2, 3, ... values: each window from two that overlap within it. A selector for
    # more values has a smaller width, so those that fit are the last ones of the table up to the wanted one.
    window, width_of_window = np.concatenate([small, np.zeros(int(COUNTS[0]), small.dtype)]), 1
    fitting = np.zeros(n, dtype=np.int8)
    for s in range(14, -1, -1):
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        step = count - width_of_window
        window, width_of_window = np.maximum(window[:-step], window[step:]), count
        fits = (window[:n] < (1 << width)) if top >= 1 << width else np.ones(n, dtype=bool)
        fits &= room >= count
        if not fits.any():
            break
        fitting += fits
    selector = (15 - fitting).astype(np.int8)
    starts = np.zeros(n, dtype=bool)
    at = np.arange(0, n, block_ids)
    ends = np.minimum(at + block_ids, n)
    step = COUNTS[selector]
    while len(at):
        starts[at] = True
        at = at + step[at]
        inside = at < ends
        at, ends = at[inside], ends[inside]
    first = np.flatnonzero(starts)
    chosen = selector[first]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        if not width:
            continue
        rows = np.flatnonzero(chosen == s)
        base = first[rows]
        packed = np.zeros(len(rows), dtype=np.uint64)
        for k in range(count):
            packed |= values[base + k] << np.uint64(k * width)
        words[rows] |= packed
    offsets = np.append(np.searchsorted(first, np.arange(0, n, block_ids)), len(first)).astype(np.uint64)
    return words, offsets, escaped.astype(np.uint64), escape_values


def unpack(words: np.ndarray) -> np.ndarray:
    """Values of whole words, in order; escapes stay ``ESCAPE``."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    base = ends - counts
    for s in np.unique(chosen):
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        if not width:
            continue
        rows = np.flatnonzero(chosen == s)
        body, mask = words[rows], np.uint64((1 << width) - 1)
        for k in range(count):
            out[base[rows] + k] = (body >> np.uint64(k * width)) & mask
    return out


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class TokenFileWriter:
    """Streams documents' ids into one file; memory holds one chunk and the tables."""

    def __init__(self, path: str, block_ids: int = BLOCK_IDS):
        filesystem, where = _filesystem(path)
        filesystem.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.out = filesystem.open_output_stream(where)
        self.block_ids = block_ids
        self.pending: list[np.ndarray] = []
        self.n_pending = self.n_ids = self.n_words = 0
        self.offsets: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.pending.append(ids)
        self.n_pending += len(ids)
        if self.n_pending >= CHUNK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint64)
        keep = len(ids) if last else len(ids) - len(ids) % self.block_ids
        words, offsets, at, values = pack(ids[:keep], self.block_ids)
        self.out.write(words.astype("<u8").tobytes())
        self.offsets.append(offsets[:-1] + np.uint64(self.n_words))
        self.escapes.append(np.stack([at + np.uint64(self.n_ids), values], axis=1))
        self.n_words += len(words)
        self.n_ids += keep
        self.pending, self.n_pending = [ids[keep:]], len(ids) - keep

    def close(self) -> None:
        self._flush(True)
        offsets = np.append(np.concatenate(self.offsets), np.uint64(self.n_words))
        escapes = np.concatenate(self.escapes)
        known = np.array([d is not None for d in self.doc_ids], dtype=np.uint8)
        for table, kind in ((offsets, "<u8"), (escapes, "<u8"), (np.array([d or 0 for d in self.doc_ids]), "<i8"), (known, "u1"), (np.array(self.lengths), "<u8")):
            self.out.write(np.asarray(table).astype(kind).tobytes())
        footer = [self.n_words, len(offsets) - 1, len(escapes), len(known), self.n_ids, self.block_ids, MAGIC]
        self.out.write(np.array(footer, dtype="<u8").tobytes())
        self.out.close()


class TokenFileReader:
    """Random access by block, and documents in order."""

    def __init__(self, path: str):
        filesystem, where = _filesystem(path)
        self.file = filesystem.open_input_file(where)
        size = self.file.size()
        footer = np.frombuffer(self._read(size - FOOTER_BYTES, FOOTER_BYTES), "<u8").tolist()
        self.n_words, self.n_blocks, n_escapes, self.n_docs, self.n_ids, self.block_ids, magic = footer
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        at = 8 * self.n_words

        def table(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(self._read(at, count * np.dtype(kind).itemsize), kind)
            at += got.nbytes
            return got

        self.offsets = table("<u8", self.n_blocks + 1)
        self.escapes = table("<u8", 2 * n_escapes).reshape(-1, 2)
        ids, known = table("<i8", self.n_docs).tolist(), table("u1", self.n_docs).tolist()
        self.doc_ids = [d if k else None for d, k in zip(ids, known)]
        self.lengths = table("<u8", self.n_docs).astype(np.int64)

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of the blocks from ``first`` up to, without, ``last``."""
        begin, end = int(self.offsets[first]), int(self.offsets[last])
        ids = unpack(np.frombuffer(self._read(8 * begin, 8 * (end - begin)), "<u8"))
        low, high = np.searchsorted(self.escapes[:, 0], [first * self.block_ids, last * self.block_ids])
        for position, value in self.escapes[low:high]:
            ids[int(position) - first * self.block_ids] = value
        return ids

    def documents(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """Each document's id and its ids, in pieces that share a chunk's array."""
        per = max(1, CHUNK_IDS // self.block_ids)
        chunk, left, block = np.zeros(0, np.uint64), 0, 0
        for doc_id, length in zip(self.doc_ids, self.lengths.tolist()):
            parts = []
            while length:
                if left == len(chunk):
                    chunk, left = self.blocks(block, min(block + per, self.n_blocks)), 0
                    block += per
                take = min(length, len(chunk) - left)
                parts.append(chunk[left : left + take])
                left += take
                length -= take
            yield doc_id, parts

    def close(self) -> None:
        self.file.close()


@dataclass(frozen=True)
class TokenFiles:
    """What a write left: the folder and, in document order, each file with its counts and first position."""

    folder: str
    files: tuple[tuple[str, int, int, int], ...]  # name, documents, ids, ids of all files before it


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None, doc_id: str = "doc_id", text: str = "text") -> TokenFiles:
    """Encode every whole text, append ``end_id`` and write the ids in ascending ``doc_id`` order.

    Documents are dealt by ranges of ``doc_id`` (an integer column; null ids first, ties by the
    hash of the text, then as they were read, so that one id's rows are split as well), and each task
    writes one run of the order. A task's file name holds its attempt, and only files named by
    rows that Spark committed count, so a task that is run again or twice leaves no double.
    Null and empty texts hold the end id alone; texts of any length are streamed in chunks. Repeated rows
    are written each. An empty table gives no files. Columns are taken by name and others
    ignored, whatever they are called.
    """
    if not isinstance(docs.schema[doc_id].dataType, IntegralType):
        raise TypeError(f"{doc_id} must be an integer column to order documents by")
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-ids")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.s8b"
        writer, docs_seen = None, 0
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i in range(0, len(ids), 256):
                for d, raw in zip(ids[i : i + 256], encoder.encode_batch([t or "" for t in texts.slice(i, 256).to_pylist()])):
                    writer = writer or TokenFileWriter(f"{folder}/{name}")
                    writer.add(d, np.concatenate([np.frombuffer(raw, "<u4"), end]))
                    docs_seen += 1
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [context.partitionId()], "file": [name], "n_docs": [docs_seen], "n_ids": [writer.n_ids]})

    ordered = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("n"))
    ordered = ordered.repartitionByRange("doc_id", "h", "n").sortWithinPartitions("doc_id", "h", "n")
    manifest = materialise(ordered.mapInArrow(write, "part bigint, file string, n_docs bigint, n_ids bigint"), "token-manifest")
    # One row per file: what a driver lists anyway when it reads a table.
    rows = sorted(tuple(r) for r in manifest.collect())
    files, before = [], 0
    for _, name, n_docs, n_ids in rows:
        files.append((name, n_docs, n_ids, before))
        before += n_ids
    return TokenFiles(folder, tuple(files))


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32; a file per task."""
    folder = files.folder

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = TokenFileReader(f"{folder}/{name}")
                rows: list[tuple] = []
                for doc_id, parts in reader.documents():
                    crc, length = 0, 0
                    for part in parts:
                        crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        length += len(part)
                    rows.append((doc_id, start, length, crc))
                    start += length
                reader.close()
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # A task is given its own file alone.
    tasks = spark.createDataFrame([(name, start) for name, _, _, start in files.files], "file string, start bigint").repartition(max(1, len(files.files)))
    return tasks.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write token files for ``docs`` and describe each document as read back from them."""
    return read_token_files(docs.sparkSession, write_token_files(docs, tokenizer_path, end_id))


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(read_table(spark, sf_dir, "documents"), default_path("word_bpe_49k.json"), 2)


__all__ = ["TokenFileReader", "TokenFileWriter", "TokenFiles", "op1_token_ids", "pack", "read_token_files", "token_ids", "unpack", "write_token_files"]
