"""Chunked arrays as a source and a sink of tidy tables.

A store is a folder of arrays in the public Zarr layout, version 2: each array a folder with ``.zarray`` (shape, chunks, dtype, compressor,
fill value), ``.zattrs`` (dimensions, scale and offset) and a file a chunk, ``0.3.1``; coordinates are arrays of one dimension. Groups (the levels of a
pyramid) are folders of such stores.

Reading makes a row of every cell that has a value. Chunks are dealt over tasks, and filters on coordinates choose
the chunks that are opened at all. Writing deals the rows by chunk, so each chunk is one task's; ``.zmetadata`` comes last, when all are there.
"""

from __future__ import annotations

import datetime
import gzip
import itertools
import json
import math
import os
import uuid
import zlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

EPOCH = datetime.date(1970, 1, 1)
#: Bytes of decoded chunks that a task reads at least, where there are so many.
TASK_BYTES = 32 << 20

_COMPARE = {EqualTo: np.equal, GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less, LessThanOrEqual: np.less_equal}


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


def _read_bytes(fs: pafs.FileSystem, path: str) -> bytes | None:
    """A file's bytes; None if there is none."""
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(path) as f:
        return f.read()


def _write_bytes(fs: pafs.FileSystem, path: str, data: bytes) -> None:
    """Put in place whole, so that a task that runs twice or dies leaves no half a file."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as f:
        f.write(data)
    fs.move(part, path)


def put_bytes(path: str, data: bytes) -> None:
    """A file of these bytes at an address."""
    _write_bytes(*_open(path), data)


def _unpack(data: bytes, compressor: dict | None) -> bytes:
    kind = (compressor or {}).get("id")
    if kind is None:
        return data
    if kind in ("zlib", "gzip"):
        return zlib.decompress(data) if kind == "zlib" else gzip.decompress(data)
    if kind == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"chunks packed by {kind!r} cannot be read")


class Store:
    """The metadata of a store: arrays by name, and the axes that place their cells."""

    def __init__(self, path: str):
        self.path = path
        fs, root = _open(path)
        found = _read_bytes(fs, f"{root}/.zmetadata")
        if found is None:
            raise FileNotFoundError(f"{path} is no array store that was written to its end")
        meta = json.loads(found)["metadata"]
        self.arrays = {k.removesuffix("/.zarray"): v | {"attrs": meta.get(k.removesuffix(".zarray") + ".zattrs", {})} for k, v in meta.items() if k.endswith("/.zarray")}
        dims = [tuple(a["attrs"]["_ARRAY_DIMENSIONS"]) for a in self.arrays.values()]
        self.dims = max(dims, key=len)
        self.variables = [k for k, a in self.arrays.items() if k not in self.dims and tuple(a["attrs"]["_ARRAY_DIMENSIONS"]) == self.dims]
        shapes = {(tuple(self.arrays[v]["shape"]), tuple(self.arrays[v]["chunks"])) for v in self.variables}
        if len(shapes) != 1:
            raise ValueError(f"the arrays of {path} differ in shape or chunks")
        self.shape, self.chunks = next(iter(shapes))

    def is_date(self, dim: str) -> bool:
        return str(self.arrays[dim]["attrs"].get("units", "")).startswith("days since ")

    def axis(self, dim: str) -> np.ndarray:
        """A coordinate's values; dates as days since 1970."""
        values = np.concatenate([self.chunk(dim, (k,)) for k in range(math.ceil(self.arrays[dim]["shape"][0] / self.arrays[dim]["chunks"][0]))])[: self.arrays[dim]["shape"][0]]
        if self.is_date(dim):
            since = datetime.date.fromisoformat(self.arrays[dim]["attrs"]["units"].removeprefix("days since ")[:10])
            values = values.astype(np.int64) + (since - EPOCH).days
        return values

    def coordinates(self, dim: str) -> list:
        """A coordinate's values as rows have them."""
        return [EPOCH + datetime.timedelta(days=x) if self.is_date(dim) else x for x in self.axis(dim).tolist()]

    def chunk(self, name: str, at: tuple[int, ...]) -> np.ndarray:
        """A chunk as it is stored; one without a file is fill values."""
        meta = self.arrays[name]
        if meta.get("filters"):
            raise ValueError(f"{name} is stored with filters, which cannot be read")
        fs, root = _open(self.path)
        data = _read_bytes(fs, f"{root}/{name}/{'.'.join(map(str, at))}")
        dtype = np.dtype(meta["dtype"])
        if data is None:
            fill = meta["fill_value"]
            return np.full(meta["chunks"], np.nan if fill in ("NaN", None) and dtype.kind == "f" else fill or 0, dtype)
        return np.frombuffer(_unpack(data, meta["compressor"]), dtype).reshape(meta["chunks"], order=meta.get("order", "C"))

    def values(self, name: str, at: tuple[int, ...], cells: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Decoded values of some cells of a chunk (by place along each dimension), and which of them are missing."""
        meta, raw = self.arrays[name], self.chunk(name, at)[np.ix_(*cells)].ravel()
        fill = meta["fill_value"]
        missing = np.isnan(raw) if raw.dtype.kind == "f" else np.zeros(len(raw), bool)
        if fill not in (None, "NaN"):
            missing |= raw == np.dtype(meta["dtype"]).type(fill)
        attrs = meta["attrs"]
        return raw * float(attrs.get("scale_factor", 1.0)) + float(attrs.get("add_offset", 0.0)), missing


class _Chunks(InputPartition):
    def __init__(self, chunks: list[tuple[int, ...]]):
        self.chunks = chunks


class ChunkReader(DataSourceReader):
    def __init__(self, store: Store, variables: list[str], keep_missing: bool, task_bytes: int):
        self.store, self.variables, self.keep_missing, self.task_bytes = store, variables, keep_missing, task_bytes
        self.axes = {d: store.axis(d) for d in store.dims}
        self.wanted = {d: np.ones(len(a), bool) for d, a in self.axes.items()}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of a coordinate with a value are done here, by place on the axis; the others stay with Spark."""
        for f in filters:
            dim = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if dim not in self.axes:
                yield f
            elif isinstance(f, IsNotNull):
                continue
            elif type(f) in _COMPARE and f.value is not None:
                self.wanted[dim] &= _COMPARE[type(f)](self.axes[dim], self._plain(dim, f.value))
            elif isinstance(f, In):
                self.wanted[dim] &= np.isin(self.axes[dim], [self._plain(dim, v) for v in f.value if v is not None])
            else:
                yield f

    def _plain(self, dim: str, value):
        return (value - EPOCH).days if self.store.is_date(dim) else value

    def partitions(self) -> list[_Chunks]:
        """The chunks with wanted cells, some of them a task."""
        needed = [np.unique(np.flatnonzero(self.wanted[d]) // n).tolist() for d, n in zip(self.store.dims, self.store.chunks)]
        each = max(1, self.task_bytes // (8 * math.prod(self.store.chunks) * max(1, len(self.variables))))
        chunks = itertools.product(*needed)
        out = []
        while part := list(itertools.islice(chunks, each)):
            out.append(_Chunks(part))
        return out or [_Chunks([])]

    def read(self, partition: _Chunks) -> Iterator[pa.RecordBatch]:
        for at in partition.chunks:
            places = [np.flatnonzero(self.wanted[d][k * n : (k + 1) * n]) for d, k, n in zip(self.store.dims, at, self.store.chunks)]
            grid = np.meshgrid(*[self.axes[d][p + k * n] for d, p, k, n in zip(self.store.dims, places, at, self.store.chunks)], indexing="ij")
            read = [self.store.values(v, at, places) for v in self.variables]
            here = np.ones(grid[0].size, bool) if self.keep_missing else ~np.logical_and.reduce([m for _, m in read])
            columns = [self._coordinate(d, g.ravel()[here]) for d, g in zip(self.store.dims, grid)]
            columns += [pa.array(x[here], pa.float64(), mask=m[here]) for x, m in read]
            yield pa.RecordBatch.from_arrays(columns, [*self.store.dims, *self.variables])

    def _coordinate(self, dim: str, values: np.ndarray) -> pa.Array:
        return pa.array(values.astype(np.int32)).cast(pa.date32()) if self.store.is_date(dim) else pa.array(values)


class ArrayChunks(DataSource):
    """Format ``array_chunks``. Options: path, variables (comma-separated; all), missing (``drop`` cells without any value, or ``keep``), taskBytes."""

    @classmethod
    def name(cls) -> str:
        return "array_chunks"

    def _variables(self, store: Store) -> list[str]:
        asked = [v.strip() for v in self.options.get("variables", "").split(",") if v.strip()]
        if unknown := set(asked) - set(store.variables):
            raise ValueError(f"{self.options['path']} has no {', '.join(sorted(unknown))}")
        return asked or store.variables

    def schema(self) -> str:
        store = Store(self.options["path"])
        kinds = {"i4": "int", "i8": "bigint", "f4": "float", "f8": "double"}
        dims = [f"{d} {'date' if store.is_date(d) else kinds[store.arrays[d]['dtype'][1:]]}" for d in store.dims]
        return ", ".join([*dims, *[f"{v} double" for v in self._variables(store)]])

    def reader(self, schema) -> ChunkReader:
        store = Store(self.options["path"])
        return ChunkReader(store, self._variables(store), self.options.get("missing", "drop") == "keep", int(self.options.get("taskBytes", TASK_BYTES)))


def read_chunks(spark: SparkSession, path: str, variables: Sequence[str] = (), group: str | None = None, missing: str = "drop", task_bytes: int = TASK_BYTES) -> DataFrame:
    """A store (or one group of it) as a tidy table: coordinates and variables; filters on coordinates decide which chunks are opened."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArrayChunks)
    reader = spark.read.format("array_chunks").option("variables", ",".join(variables)).option("missing", missing).option("taskBytes", task_bytes)
    return reader.load(path if group is None else f"{path}/{group}")


def _axis(df: DataFrame, dim: str) -> list:
    """A coordinate's values in order: what the array's own metadata holds too."""
    return sorted(r[0] for r in df.select(dim).filter(F.col(dim).isNotNull()).distinct().collect())


def write_chunks(df: DataFrame, path: str, chunks: Mapping[str, int], variables: Sequence[str], packed: Mapping[str, tuple[float, float]] | None = None, axes: Mapping[str, Sequence] | None = None, group: str | None = None, level: int = 1, append: bool = False) -> int:
    """Rows of (coordinates, variables) as a store; returns how many chunks it has.

    With ``append`` the variables are put beside those of a store that is there: its axes and chunks hold, ``chunks`` names the dimensions alone, and variables
    of the same name are replaced. Until all is written the store reads as it was before.

    ``chunks`` names the dimensions, in order, and the length of a chunk along each. Variables of ``packed`` are kept as integers of 32 bits by
    (scale, offset), rounded. Axes are the coordinates that occur, unless given. Rows with a null coordinate or one off the axes are
    left out; two rows for one cell are an error. Coordinates are dates, integers or doubles.
    """
    path, packed = path if group is None else f"{path}/{group}", dict(packed or {})
    dims, kinds = list(chunks), dict(df.dtypes)
    fs, root = _open(path)
    old = Store(path) if append else None
    if old and list(old.dims) != dims:
        raise ValueError(f"{path} has the dimensions {', '.join(old.dims)}")
    axis = {d: old.coordinates(d) if old else list((axes or {}).get(d) or _axis(df, d)) for d in dims}
    shape = [len(axis[d]) for d in dims]
    lengths = list(old.chunks) if old else [min(chunks[d], max(1, n)) for d, n in zip(dims, shape)]
    types = {v: "<i4" if v in packed else "<f8" for v in variables}
    fill = {v: -(2**31) if v in packed else "NaN" for v in variables}
    for name in (*dims, *variables):
        fs.create_dir(f"{root}/{name}", recursive=True)
    if not old and _read_bytes(fs, f"{root}/.zmetadata") is not None:
        fs.delete_file(f"{root}/.zmetadata")

    rows = df
    for d in dims:  # an axis is as long as the array is along it
        table = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(axis[d])], f"{d} {kinds[d]}, _at_{d} int")
        rows = rows.join(F.broadcast(table), d)
    number = F.lit(0).cast("bigint")
    for d, n, k in zip(dims, shape, lengths):
        number = number * max(1, math.ceil(n / k)) + F.floor(F.col(f"_at_{d}") / k)
    rows = rows.select(number.alias("_chunk"), *[(F.col(f"_at_{d}") % k).alias(f"_at_{d}") for d, k in zip(dims, lengths)], *[F.col(v).cast("double").alias(v) for v in variables])
    grid = [max(1, math.ceil(n / k)) for n, k in zip(shape, lengths)]

    def write(table: pa.Table) -> pa.Table:
        fs, root = _open(path)
        chunk = table["_chunk"][0].as_py()
        at = np.unravel_index(chunk, grid)
        place = np.ravel_multi_index([table[f"_at_{d}"].to_numpy() for d in dims], lengths)
        if len(np.unique(place)) < len(place):
            raise ValueError(f"two rows for one cell in chunk {'.'.join(map(str, at))} of {path}")
        for v in variables:
            values = table[v].to_numpy().astype(float)
            cells = np.full(math.prod(lengths), np.nan)
            cells[place] = values
            if v in packed:
                scale, offset = packed[v]
                cells = np.where(np.isnan(cells), float(fill[v]), np.rint((cells - offset) / scale))
            _write_bytes(fs, f"{root}/{v}/{'.'.join(map(str, at))}", zlib.compress(cells.astype(types[v]).tobytes(), level))
        return pa.table({"chunk": pa.array([chunk], pa.int64())})

    n_chunks = rows.groupBy("_chunk").applyInArrow(write, "chunk bigint").count()

    metadata: dict[str, dict] = {".zgroup": {"zarr_format": 2}, ".zattrs": {}}
    if old:
        metadata = json.loads(_read_bytes(fs, f"{root}/.zmetadata"))["metadata"]
    for d in dims if not old else ():
        date = kinds[d] == "date"
        values = np.array([(v - EPOCH).days if date else v for v in axis[d]], {"int": "<i4", "bigint": "<i8", "float": "<f4", "double": "<f8"}.get(kinds[d], "<i4"))
        _write_bytes(fs, f"{root}/{d}/0", zlib.compress(values.tobytes(), level))
        metadata[f"{d}/.zarray"] = _array(values.shape, [max(1, len(values))], values.dtype.str, None, level)
        metadata[f"{d}/.zattrs"] = {"_ARRAY_DIMENSIONS": [d]} | ({"units": f"days since {EPOCH}", "calendar": "standard"} if date else {})
    for v in variables:
        metadata[f"{v}/.zarray"] = _array(shape, lengths, types[v], fill[v], level)
        metadata[f"{v}/.zattrs"] = {"_ARRAY_DIMENSIONS": dims} | (dict(zip(("scale_factor", "add_offset"), packed[v])) if v in packed else {})
    for name, content in metadata.items():
        _write_bytes(fs, f"{root}/{name}", json.dumps(content).encode())
    _write_bytes(fs, f"{root}/.zmetadata", json.dumps({"zarr_consolidated_format": 1, "metadata": metadata}).encode())
    return n_chunks


def _array(shape: Sequence[int], chunks: Sequence[int], dtype: str, fill, level: int) -> dict:
    return {"zarr_format": 2, "shape": list(shape), "chunks": list(chunks), "dtype": dtype, "compressor": {"id": "zlib", "level": level}, "fill_value": fill, "order": "C", "filters": None}
