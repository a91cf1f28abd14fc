"""Record files: length-prefixed records with masked CRC32C, each an example message of named features.

A record is its length (u64), the masked checksum of those eight bytes (u32), the data, and the data's masked checksum (u32), all
little-endian. An example is the public wire format of nested messages: example.features(1).feature(1) entries of name(1)
and value(2), a value being lists of bytes(1), floats(2, packed) or integers(3, packed).

Files are written by tasks and read in byte ranges: a range begins at the first place where a length and its checksum agree, so
one large file is many tasks' work. Records that do not agree with their checksums are reported by file and offset.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, BinaryType, ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType

from .chunks import _open

RANGE_BYTES = 32 << 20
HEADER, TRAILER = 12, 4
#: Records whose checksums are made at once.
TOGETHER = 256

# Fixed values of the format: the polynomial of CRC-32C, reversed, and what a masked checksum adds.
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8


def _table() -> np.ndarray:
    reg = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        reg = np.where(reg & 1, (reg >> 1) ^ np.uint32(POLYNOMIAL), reg >> 1).astype(np.uint32)
    return reg


_TABLE = _table()


def crc32c(messages: Sequence[bytes]) -> np.ndarray:
    """The CRC-32C of each message, of all side by side.

    A register of ones at the start is the same as inverting the first four bytes, after which leading zeros change nothing; so
    messages are brought to one length by zeros in front.
    """
    lengths = [max(4, len(m)) for m in messages]
    longest = max(lengths, default=0)
    rows = np.zeros((len(messages), longest), np.uint8)
    for row, m, n in zip(rows, messages, lengths):
        if len(m) >= 4:
            row[longest - n :] = np.frombuffer(m, np.uint8)
            row[longest - n : longest - n + 4] ^= 0xFF
    reg = np.zeros(len(messages), np.uint32)
    for column in rows.T:
        reg = _TABLE[(reg ^ column) & 0xFF] ^ (reg >> np.uint32(8))
    out = reg ^ np.uint32(0xFFFFFFFF)
    for i, m in enumerate(messages):
        if len(m) < 4:
            short = 0xFFFFFFFF
            for b in m:
                short = int(_TABLE[(short ^ b) & 0xFF]) ^ (short >> 8)
            out[i] = short ^ 0xFFFFFFFF
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    crc = np.asarray(crc, np.uint64)
    return (((crc >> 15 | crc << 17) & 0xFFFFFFFF) + MASK & 0xFFFFFFFF).astype(np.uint32)


def frame(messages: Sequence[bytes]) -> bytes:
    """Messages as records, one after another."""
    heads = [struct.pack("<Q", len(m)) for m in messages]
    out = []
    for head, m, a, b in zip(heads, messages, masked(crc32c(heads)).tolist(), masked(crc32c(messages)).tolist()):
        out += [head, struct.pack("<I", a), m, struct.pack("<I", b)]
    return b"".join(out)


# ---------------------------------------------------------------- examples


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def encode_example(features: dict[str, object]) -> bytes:
    """An example of features by name: bytes and text, floats (or an array of them), integers (or a list of them); a null is a feature without values."""
    out = []
    for name, value in features.items():
        if value is None:
            kind = b""
        elif isinstance(value, (bytes, str)):
            kind = _field(1, _field(1, value.encode() if isinstance(value, str) else value))
        else:
            values = np.atleast_1d(np.asarray(value))
            whole = values.dtype.kind in "iub"
            packed = b"".join(map(_varint, values.tolist())) if whole else values.astype("<f4").tobytes()
            kind = _field(3 if whole else 2, _field(1, packed))
        out.append(_field(1, _field(1, name.encode()) + _field(2, kind)))
    return _field(1, b"".join(out))


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if b < 0x80:
            return n, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a message's fields."""
    at = 0
    while at < len(data):
        key, at = _read_varint(data, at)
        if key & 7 == 2:
            size, at = _read_varint(data, at)
            if at + size > len(data):
                raise ValueError("a field reaches beyond its message")
            yield key >> 3, data[at : at + size]
            at += size
        elif key & 7 == 0:
            value, at = _read_varint(data, at)
            yield key >> 3, value
        elif key & 7 in (1, 5):
            size = 8 if key & 7 == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"a field of unknown kind {key & 7}")


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def decode_example(data: bytes) -> dict[str, object]:
    """Features by name: lists of bytes, arrays of floats, lists of integers; packed or not."""
    out: dict[str, object] = {}
    for _, features in (f for f in _fields(data) if f[0] == 1):
        for _, entry in (f for f in _fields(features) if f[0] == 1):
            parts = dict(_fields(entry))
            for kind, held in _fields(parts.get(2, b"")):
                values = [v for n, v in _fields(held) if n == 1]
                if kind == 1:
                    out[parts[1].decode()] = values
                elif kind == 2:
                    out[parts[1].decode()] = np.frombuffer(b"".join(values), "<f4")
                elif kind == 3:
                    whole: list[int] = []
                    for v in values:
                        if isinstance(v, int):
                            whole.append(_signed(v))
                            continue
                        at = 0
                        while at < len(v):
                            n, at = _read_varint(v, at)
                            whole.append(_signed(n))
                    out[parts[1].decode()] = whole
    return out


# ---------------------------------------------------------------- writing


def write_examples(df: DataFrame, path: str) -> int:
    """Every row as an example, a file a task; returns the number of records. What was at ``path`` before goes.

    A task writes under a name of its attempt; files are given their names when the job has ended, so tasks that ran twice leave nothing behind.
    """
    names = df.columns
    fs, root = _open(path)
    if fs.get_file_info(root).type == pafs.FileType.Directory:
        fs.delete_dir(root)
    attempts = f"{root}/_attempts-{uuid.uuid4().hex}"
    fs.create_dir(attempts, recursive=True)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, context, out, n = _open(path)[0], TaskContext.get(), None, 0
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        for batch in batches:
            for i in range(0, batch.num_rows, TOGETHER):
                rows = batch.slice(i, TOGETHER).to_pylist()
                out = out or fs.open_output_stream(f"{attempts}/{name}")
                out.write(frame([encode_example({k: row[k] for k in names}) for row in rows]))
                n += len(rows)
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [name], "n": pa.array([n], pa.int64())})

    done = df.mapInArrow(write, "name string, n bigint").collect()  # a row a file
    for r in done:
        fs.move(f"{attempts}/{r.name}", f"{root}/{r.name.rsplit('-', 1)[0]}.records")
    fs.delete_dir(attempts)
    return sum(r.n for r in done)


# ---------------------------------------------------------------- reading


class _Range(InputPartition):
    def __init__(self, file: str, start: int, end: int, size: int):
        self.file, self.start, self.end, self.size = file, start, end, size


class RecordReader(DataSourceReader):
    def __init__(self, path: str, strict: bool, range_bytes: int):
        self.path, self.strict, self.range_bytes = path, strict, range_bytes

    def partitions(self) -> list[_Range]:
        fs, root = _open(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and not any(p.startswith(("_", ".")) for p in f.path[len(root) :].split("/")))
        return [_Range(f, a, min(a + self.range_bytes, size), size) for f, size in files for a in range(0, size, self.range_bytes)] or [_Range("", 0, 0, 0)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        fs, _ = _open(self.path)
        with fs.open_input_file(part.file) as f:
            rows: list[tuple[int, bytes | None, str | None]] = []
            for row in _records(f, part):
                rows.append(row)
                if len(rows) == TOGETHER:
                    yield self._checked(part.file, rows)
                    rows = []
            if rows:
                yield self._checked(part.file, rows)

    def _checked(self, file: str, rows: list[tuple[int, bytes | None, str | None]]) -> pa.RecordBatch:
        """Records of (offset, data and trailer, fault) with their data held against the checksum."""
        bodies = [body[:-TRAILER] if body is not None else b"" for _, body, _ in rows]
        right = masked(crc32c(bodies))
        columns: list[list] = [[], [], [], []]
        for (offset, body, fault), data, crc in zip(rows, bodies, right.tolist()):
            if fault is None and struct.unpack("<I", body[-TRAILER:])[0] != crc:
                fault = "the data does not agree with its checksum"
            if fault and self.strict:
                raise ValueError(f"{file}, offset {offset}: {fault}")
            for c, v in zip(columns, (file, offset, None if fault else data, fault)):
                c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.string())], ["file", "offset", "data", "fault"])


def _header_ok(head: bytes) -> bool:
    return len(head) == HEADER and struct.unpack("<I", head[8:])[0] == int(masked(crc32c([head[:8]]))[0])


def _next_header(f, at: int, end: int, size: int) -> int | None:
    """The first place from ``at`` and before ``end`` where a record begins: its header agrees, and so does the next record's, or its data."""
    window = 1 << 16
    while at < end:
        f.seek(at)
        raw = np.frombuffer(f.read(min(window, end - at) + HEADER - 1), np.uint8)
        if len(raw) < HEADER:
            return None
        views = np.lib.stride_tricks.sliding_window_view(raw, HEADER)
        reg = np.full(len(views), 0xFFFFFFFF, np.uint32)
        for k in range(8):
            reg = _TABLE[(reg ^ views[:, k]) & 0xFF] ^ (reg >> np.uint32(8))
        stored = views[:, 8:].astype(np.uint32) << np.array([0, 8, 16, 24], np.uint32)
        for k in np.flatnonzero(masked(reg ^ np.uint32(0xFFFFFFFF)) == stored.sum(axis=1, dtype=np.uint32)).tolist():
            length = int(np.frombuffer(raw[k : k + 8].tobytes(), "<u8")[0])
            following = at + k + HEADER + length + TRAILER
            if following > size:
                continue
            f.seek(following)
            if following == size or _header_ok(f.read(HEADER)):
                return at + k
            f.seek(at + k + HEADER)
            body = f.read(length + TRAILER)
            if struct.unpack("<I", body[-TRAILER:])[0] == int(masked(crc32c([body[:-TRAILER]]))[0]):
                return at + k
        at += window
    return None


def _records(f, part: _Range) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(offset, data and trailer, fault) of the records that begin in a range, and of the places where none can be read."""
    at = part.start if part.start == 0 else _next_header(f, part.start, part.end, part.size)
    while at is not None and at < part.end:
        f.seek(at)
        head = f.read(HEADER)
        if not _header_ok(head):
            yield at, None, "the length does not agree with its checksum" if len(head) == HEADER else "the file ends within a record"
            at = _next_header(f, at + 1, part.end, part.size)
            continue
        length = struct.unpack("<Q", head[:8])[0]
        if at + HEADER + length + TRAILER > part.size:
            yield at, None, "the file ends within a record"
            at = _next_header(f, at + 1, part.end, part.size)
            continue
        yield at, f.read(length + TRAILER), None
        at += HEADER + length + TRAILER


class RecordFiles(DataSource):
    """Format ``record_files``. Options: path, strict (true: a broken record is an error), rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "record_files"

    def schema(self) -> str:
        return "file string, offset bigint, data binary, fault string"

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options["path"], self.options.get("strict", "true") == "true", int(self.options.get("rangeBytes", RANGE_BYTES)))


def read_records(spark: SparkSession, path: str, strict: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """file, offset, data, fault of each record of a file or folder; without ``strict`` broken ones are rows with a fault and no data."""
    spark.dataSource.register(RecordFiles)
    return spark.read.format("record_files").option("strict", str(strict).lower()).option("rangeBytes", range_bytes).load(path)


_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_FLOATING = (FloatType, DoubleType)


def read_examples(spark: SparkSession, path: str, schema: str | StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Examples as rows: features by the names of ``schema``, of integers, floats, strings, binary or arrays of these; one that is absent is null."""
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def plain(kind, values):
        if values is None or (len(values) == 0 and not isinstance(kind, ArrayType)):
            return None
        each = kind.elementType if isinstance(kind, ArrayType) else kind
        if isinstance(each, _FLOATING):
            out = np.asarray(values, np.float64).tolist()
        elif isinstance(each, (StringType, BinaryType)):
            out = [v.decode() if isinstance(each, StringType) else v for v in values]
        elif isinstance(each, _WHOLE):
            out = [int(v) for v in values]
        else:
            raise TypeError(f"no feature holds {each.simpleString()}")
        return out if isinstance(kind, ArrayType) else out[0]

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            examples = [decode_example(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([plain(f.dataType, e.get(f.name)) for e in examples], t.type) for f, t in zip(schema.fields, arrow)], schema.names)

    return read_records(spark, path, True, range_bytes).select("data").mapInArrow(decode, schema)
