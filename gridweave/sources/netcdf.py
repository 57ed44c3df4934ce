"""Classic NetCDF files (versions 1, 2 and 5) as cell relations; NetCDF-4 files are HDF5 and are not read."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridweave.sources.workers import map_arrow

#: Big-endian types by their number (fixed values of the format).
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: ">u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}


class _Reader:
    def __init__(self, data: bytes) -> None:
        if data[:3] != b"CDF" or data[3] not in (1, 2, 5):
            raise ValueError("no classic NetCDF file")
        self.data, self.at, self.version = data, 4, data[3]

    def number(self, kind: str) -> int:
        value = struct.unpack_from(">" + kind, self.data, self.at)[0]
        self.at += struct.calcsize(kind)
        return value

    def count(self) -> int:
        return self.number("q" if self.version == 5 else "i")

    def padded(self, size: int) -> bytes:
        raw = self.data[self.at : self.at + size]
        self.at += -(-size // 4) * 4
        return raw

    def name(self) -> str:
        return self.padded(self.count()).decode("utf-8")

    def items(self) -> range:
        self.number("i")
        return range(self.count())

    def attributes(self) -> dict:
        out = {}
        for _ in self.items():
            name, kind = self.name(), np.dtype(TYPES[self.number("i")])
            n = self.count()
            values = np.frombuffer(self.padded(n * kind.itemsize), kind)
            out[name] = b"".join(values).decode("latin-1") if kind.kind == "S" else values
        return out


def variables(data: bytes) -> dict[str, tuple[tuple[str, ...], np.ndarray, dict]]:
    """Each variable's dimensions, values and attributes."""
    r = _Reader(data)
    records = r.count()
    dims = [(r.name(), r.count()) for _ in r.items()]
    r.attributes()
    found = []
    for _ in r.items():
        name, own = r.name(), None
        own = [r.count() for _ in range(r.count())]
        attributes, kind = r.attributes(), np.dtype(TYPES[r.number("i")])
        size, begin = r.count(), r.number("i" if r.version == 1 else "q")
        found.append((name, own, attributes, kind, size, begin))
    moving = [f for f in found if f[1] and dims[f[1][0]][1] == 0]
    stride = sum(f[4] for f in moving) if len(moving) != 1 else int(np.prod([dims[d][1] for d in moving[0][1][1:]], dtype=int)) * moving[0][3].itemsize
    out = {}
    for name, own, attributes, kind, _, begin in found:
        shape = [dims[d][1] for d in own]
        if own and shape[0] == 0:
            each = int(np.prod(shape[1:], dtype=int))
            rows = [np.frombuffer(data, kind, each, begin + i * stride) for i in range(records)]
            values = np.concatenate(rows or [np.zeros(0, kind)]).reshape(records, *shape[1:])
        else:
            values = np.frombuffer(data, kind, int(np.prod(shape, dtype=int)), begin).reshape(shape)
        out[name] = (tuple(dims[d][0] for d in own), values, attributes)
    return out


def cells(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """Cells of a two-dimensional variable that have a value: ``file``, ``y``, ``x``, ``lon``, ``lat``, ``z``; rows are latitudes, in the file's order.

    Coordinates are those of the variables named like the dimensions. Fill values and NaN are nodata; scale and offset are applied. A file is
    read whole by a task.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                known = variables(content.as_py())
                (rows, columns), raw, attributes = known[variable]
                values = raw.astype(float)
                empty = ~np.isfinite(values)
                for key in ("_FillValue", "missing_value"):
                    if key in attributes:
                        empty |= raw == attributes[key][0]
                values = values * float(attributes.get("scale_factor", [1.0])[0]) + float(attributes.get("add_offset", [0.0])[0])
                lat, lon = known[rows][1].astype(float), known[columns][1].astype(float)
                y, x = np.nonzero(~empty)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(y), pa.string()), pa.array(y), pa.array(x), pa.array(lon[x]), pa.array(lat[y]), pa.array(values[y, x])], names=["file", "y", "x", "lon", "lat", "z"])

    return map_arrow(files, run, "file string, y bigint, x bigint, lon double, lat double, z double")
