"""Regions as classic NetCDF files (the 64-bit offset variant): a header, then each variable's values, big-endian.

Where each value goes follows from the header alone. So the driver lays the file out, and tasks write their steps of every variable at
computed offsets, side by side; a task that runs again writes the same bytes at the same places. That needs a file system all machines mount
(``file://``); exports of regions and point series, which this format is for, are small beside the stores they are taken from.
"""

from __future__ import annotations

import datetime
import math
import os
import struct
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import EPOCH, _axis

# Fixed values of the format: tags of lists, types, and the value of cells that were never written.
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12
CHAR, INT, DOUBLE = 2, 4, 6
FILL = 9.969209968386869e36
_TYPES = {INT: ">i4", DOUBLE: ">f8"}

#: Bytes of steps that a task writes at once.
SLAB_BYTES = 16 << 20


def _local(path: str) -> str:
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"{path}: NetCDF files are written in place, which needs a mounted file system")
    return path.removeprefix("file://")


def _name(text: str) -> bytes:
    raw = text.encode()
    return struct.pack(">I", len(raw)) + raw + b"\0" * (-len(raw) % 4)


def _attributes(values: dict[str, str | float]) -> bytes:
    if not values:
        return struct.pack(">II", 0, 0)
    out = [struct.pack(">II", ATTRIBUTE, len(values))]
    for name, v in values.items():
        if isinstance(v, str):
            raw = v.encode()
            out.append(_name(name) + struct.pack(">II", CHAR, len(raw)) + raw + b"\0" * (-len(raw) % 4))
        else:
            out.append(_name(name) + struct.pack(">II", DOUBLE, 1) + struct.pack(">d", v))
    return b"".join(out)


def layout(sizes: dict[str, int], arrays: dict[str, tuple[list[str], int, dict]]) -> tuple[bytes, dict[str, int], int]:
    """The header of arrays (dimensions, type, attributes), where each begins, and the file's length."""

    def header(begins: dict[str, int]) -> bytes:
        out = [b"CDF\x02", struct.pack(">I", 0), struct.pack(">II", DIMENSION, len(sizes)), *[_name(d) + struct.pack(">I", n) for d, n in sizes.items()], _attributes({}), struct.pack(">II", VARIABLE, len(arrays))]
        for name, (dims, kind, attributes) in arrays.items():
            size = math.prod(sizes[d] for d in dims) * np.dtype(_TYPES[kind]).itemsize
            out += [_name(name), struct.pack(">I", len(dims)), *[struct.pack(">I", list(sizes).index(d)) for d in dims], _attributes(attributes), struct.pack(">IIQ", kind, min(size + -size % 4, 2**32 - 1), begins[name])]
        return b"".join(out)

    at, begins = len(header(dict.fromkeys(arrays, 0))), {}
    for name, (dims, kind, _) in arrays.items():
        begins[name] = at
        size = math.prod(sizes[d] for d in dims) * np.dtype(_TYPES[kind]).itemsize
        at += size + -size % 4
    return header(begins), begins, at


def write_netcdf(df: DataFrame, path: str, dims: Sequence[str], variables: Sequence[str], slab_bytes: int = SLAB_BYTES) -> None:
    """Rows of coordinates (dates, integers or doubles) and variables as one file; cells without a row or value hold the fill value.

    Axes are the coordinates that occur. Two rows for one cell are an error, rows with a null coordinate are left out.
    """
    file, kinds = _local(path), dict(df.dtypes)
    axis = {d: _axis(df, d) for d in dims}
    sizes = {d: len(axis[d]) for d in dims}
    arrays = {d: ([d], DOUBLE if kinds[d] in ("double", "float") else INT, {"units": f"days since {EPOCH}"} if kinds[d] == "date" else {}) for d in dims}
    arrays |= {v: (list(dims), DOUBLE, {"_FillValue": FILL}) for v in variables}
    header, begins, length = layout(sizes, arrays)
    os.makedirs(os.path.dirname(file), exist_ok=True)
    with open(file, "wb") as out:
        out.write(header)
        for d in dims:
            values = [(x - EPOCH).days if kinds[d] == "date" else x for x in axis[d]]
            out.seek(begins[d])
            out.write(np.array(values, _TYPES[arrays[d][1]]).tobytes())
        out.truncate(length)

    step = math.prod(sizes[d] for d in dims[1:])
    each = max(1, slab_bytes // (8 * max(1, step)))
    rows = df
    for d in dims:
        table = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(axis[d])], f"{d} {kinds[d]}, _at_{d} int")
        rows = rows.join(F.broadcast(table), d)
    rows = rows.select(F.floor(F.col(f"_at_{dims[0]}") / each).alias("_slab"), *[F.col(f"_at_{d}") for d in dims], *[F.col(v).cast("double").alias(v) for v in variables])
    # Every slab has rows of its own: a step is on the axis because it occurs.

    def write(table: pa.Table) -> pa.Table:
        slab = table["_slab"][0].as_py()
        first, steps = slab * each, min(each, sizes[dims[0]] - slab * each)
        place = np.ravel_multi_index([table[f"_at_{dims[0]}"].to_numpy() - first, *[table[f"_at_{d}"].to_numpy() for d in dims[1:]]], [steps, *[sizes[d] for d in dims[1:]]])
        if len(np.unique(place)) < len(place):
            raise ValueError(f"two rows for one cell of {path}")
        with open(file, "r+b") as out:
            for v in variables:
                values = table[v].to_numpy().astype(float)
                cells = np.full(steps * step, FILL, ">f8")
                cells[place] = np.where(np.isnan(values), FILL, values)
                os.pwrite(out.fileno(), cells.tobytes(), begins[v] + 8 * step * first)
        return pa.table({"slab": pa.array([slab], pa.int64())})

    rows.groupBy("_slab").applyInArrow(write, "slab bigint").count()


def header_of(path: str) -> tuple[dict[str, int], dict[str, tuple[list[str], int, dict, int]]]:
    """Dimensions, and arrays by name (dimensions, type, attributes, first byte), of a classic file of either offset size."""
    with open(_local(path), "rb") as f:
        magic = f.read(4)
        if magic not in (b"CDF\x01", b"CDF\x02"):
            raise ValueError(f"{path} is no classic NetCDF file")
        number = lambda: struct.unpack(">I", f.read(4))[0]

        def name() -> str:
            n = number()
            return f.read(n + -n % 4)[:n].decode()

        def listed(read) -> list:
            _, n = number(), number()
            return [read() for _ in range(n)]

        def attribute():
            key, kind, n = name(), number(), number()
            size = n * {1: 1, CHAR: 1, 3: 2, INT: 4, 5: 4, DOUBLE: 8}[kind]
            raw = f.read(size + -size % 4)[:size]
            return key, raw.decode() if kind == CHAR else np.frombuffer(raw, {1: ">i1", 3: ">i2", INT: ">i4", 5: ">f4", DOUBLE: ">f8"}[kind]).tolist()[0]

        number()  # records
        dims = listed(lambda: (name(), number()))
        listed(attribute)

        def variable():
            key = name()
            own = [dims[number()][0] for _ in range(number())]
            attributes, kind, _ = dict(listed(attribute)), number(), number()
            begin = number() if magic[3] == 1 else struct.unpack(">Q", f.read(8))[0]
            return key, (own, kind, attributes, begin)

        return dict(dims), dict(listed(variable))


def read_netcdf(spark: SparkSession, path: str, variables: Sequence[str], slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """Every cell of arrays of the same dimensions as a row; fill values are null. Tasks read steps of the first dimension."""
    file, (sizes, arrays) = _local(path), header_of(path)
    dims = arrays[variables[0]][0]
    step = math.prod(sizes[d] for d in dims[1:])
    each = max(1, slab_bytes // (8 * max(1, step)))
    dates = {d: str(arrays[d][2].get("units", "")).startswith("days since") for d in dims}

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def values(name: str, first: int, n: int) -> np.ndarray:
            dtype = np.dtype(_TYPES[arrays[name][1]])
            with open(file, "rb") as f:
                return np.frombuffer(os.pread(f.fileno(), n * dtype.itemsize, arrays[name][3] + first * dtype.itemsize), dtype).astype(dtype.newbyteorder("="))

        axes = {d: values(d, 0, sizes[d]) for d in dims}
        for batch in batches:
            for slab in batch.column(0).to_pylist():
                first, steps = slab * each, min(each, sizes[dims[0]] - slab * each)
                grid = np.meshgrid(axes[dims[0]][first : first + steps], *[axes[d] for d in dims[1:]], indexing="ij")
                columns = []
                for d, g in zip(dims, grid):
                    g = g.ravel()
                    if dates[d]:
                        since = datetime.date.fromisoformat(arrays[d][2]["units"].removeprefix("days since ")[:10])
                        columns.append(pa.array((g + (since - EPOCH).days).astype(np.int32)).cast(pa.date32()))
                    else:
                        columns.append(pa.array(g))
                for v in variables:
                    x = values(v, first * step, steps * step)
                    columns.append(pa.array(x, mask=np.isnan(x) | (x == arrays[v][2].get("_FillValue", FILL))))
                yield pa.RecordBatch.from_arrays(columns, [*dims, *variables])

    kinds = [f"{d} {'date' if dates[d] else 'int' if arrays[d][1] == INT else 'double'}" for d in dims] + [f"{v} double" for v in variables]
    return spark.range(0, -(-sizes[dims[0]] // each)).mapInArrow(read, ", ".join(kinds))
