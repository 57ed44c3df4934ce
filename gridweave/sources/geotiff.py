"""GeoTIFF files as cell relations and back: strips or tiles, plain or deflated, one or more bands, with their place and nodata value."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.sources.workers import group_arrow, map_arrow

#: Bytes of a value by TIFF field type, and how it is unpacked (fixed values of the format).
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
#: Tag numbers (fixed values of the format and its geographic extension).
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, BANDS, ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT, SCALE, TIE, NODATA = 322, 323, 324, 325, 339, 33550, 33922, 42113


@dataclass(frozen=True)
class Raster:
    """Bands (band x row x column), west and north edge, cell width and height, and the value that stands for nodata."""

    bands: np.ndarray
    west: float
    north: float
    width: float
    height: float
    nodata: float | None


def _tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("no TIFF file")
    at = struct.unpack_from(order + "I", data, 4)[0]
    out: dict[int, tuple] = {}
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, n, _ = struct.unpack_from(order + "HHII", data, at + 2 + 12 * i)
        code = TYPES.get(kind)
        if code is None:
            continue
        size = struct.calcsize(code) * n
        place = at + 2 + 12 * i + 8 if size <= 4 else struct.unpack_from(order + "I", data, at + 2 + 12 * i + 8)[0]
        out[tag] = (data[place : place + n].rstrip(b"\0").decode("latin-1"),) if code == "s" else struct.unpack_from(f"{order}{n}{code}", data, place)
    return order, out


def parse(data: bytes) -> Raster:
    """A file's first image. Compressions other than none and deflate raise."""
    order, tags = _tags(data)
    width, height, n = tags[WIDTH][0], tags[HEIGHT][0], tags.get(BANDS, (1,))[0]
    kind = {1: "u", 2: "i", 3: "f"}[tags.get(FORMAT, (1,))[0]]
    dtype = np.dtype(f"{order}{kind}{tags[BITS][0] // 8}")
    packed, predictor = tags.get(COMPRESSION, (1,))[0], tags.get(PREDICTOR, (1,))[0]
    if packed not in (1, 8, 32946) or predictor not in (1, 2):
        raise ValueError(f"compression {packed} with predictor {predictor} is not read")
    tiled = TILES in tags
    tw, th = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if tiled else (width, min(height, tags.get(ROWS, (height,))[0]))
    starts, sizes = (tags[TILES], tags[TILE_BYTES]) if tiled else (tags[STRIPS], tags[STRIP_BYTES])
    apart = tags.get(PLANAR, (1,))[0] == 2
    across, down = -(-width // tw), -(-height // th)
    out = np.zeros((n, height, width), dtype.newbyteorder("="))
    for i, (start, size) in enumerate(zip(starts, sizes)):
        raw = data[start : start + size]
        raw = zlib.decompress(raw) if packed != 1 else raw
        each = 1 if apart else n
        plane, cell = divmod(i, across * down)
        top, left = cell // across * th, cell % across * tw
        values = np.frombuffer(raw, dtype)
        block = values[: len(values) // (tw * each) * tw * each].reshape(-1, tw, each)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=block.dtype)
        part = block[: height - top, : width - left].transpose(2, 0, 1)
        bands = slice(plane, plane + 1) if apart else slice(0, n)
        out[bands, top : top + part.shape[1], left : left + part.shape[2]] = part
    scale, tie = tags.get(SCALE, (1.0, 1.0, 0.0)), tags.get(TIE, (0.0,) * 6)
    nodata = float(tags[NODATA][0]) if NODATA in tags and tags[NODATA][0].strip() else None
    return Raster(out, tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], scale[0], scale[1], nodata)


def encode(raster: Raster) -> bytes:
    """A deflated GeoTIFF with a strip for each band and row block, in degrees."""
    bands = np.asarray(raster.bands, "<f4")
    n, height, width = bands.shape
    rows = max(1, min(height, 65_536 // max(1, width)))
    strips = [zlib.compress(bands[b, top : top + rows].tobytes()) for b in range(n) for top in range(0, height, rows)]
    body, starts, at = b"".join(strips), [], 8
    for s in strips:
        starts.append(at)
        at += len(s)
    text = b"" if raster.nodata is None else f"{raster.nodata:g}".encode() + b"\0"
    entries: list[tuple[int, int, list | bytes]] = [
        (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [32] * n), (COMPRESSION, 3, [8]), (262, 3, [1]), (STRIPS, 4, starts), (BANDS, 3, [n]), (ROWS, 4, [rows]), (STRIP_BYTES, 4, [len(s) for s in strips]),
        (PLANAR, 3, [2]), (FORMAT, 3, [3] * n), (SCALE, 12, [raster.width, raster.height, 0.0]), (TIE, 12, [0.0, 0.0, 0.0, raster.west, raster.north, 0.0]), (34735, 3, [1, 1, 0, 2, 1024, 0, 1, 2, 2048, 0, 1, 4326]),
    ]
    entries += [(NODATA, 2, text)] if text else []
    directory, extra = b"", b""
    after = at + 2 + 12 * len(entries) + 4
    for tag, kind, values in entries:
        raw = values if isinstance(values, bytes) else struct.pack(f"<{len(values)}{TYPES[kind]}", *values)
        count = len(values)
        directory += struct.pack("<HHI", tag, kind, count) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", after + len(extra)))
        extra += raw if len(raw) > 4 else b""
    return b"II*\0" + struct.pack("<I", at) + body + struct.pack("<H", len(entries)) + directory + b"\0\0\0\0" + extra


def cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells of the files at ``path`` that have a value in some band: ``file``, ``y``, ``x``, ``lon``, ``lat`` of their centres, ``bands``.

    A file is read whole by a task, so large rasters are to be cut into files of some tens of megabytes. Nodata and NaN are null.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                r = parse(content.as_py())
                values = r.bands.astype(float)
                empty = ~np.isfinite(values) | ((values == r.nodata) if r.nodata is not None else False)
                for y in range(values.shape[1]):
                    x = np.flatnonzero(~empty[:, y].all(0))
                    lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(values), pa.array(values[:, y, x].T.ravel(), mask=empty[:, y, x].T.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(x), pa.string()), pa.array(np.full(len(x), y)), pa.array(x), pa.array(r.west + (x + 0.5) * r.width), pa.array(np.full(len(x), r.north - (y + 0.5) * r.height)), lists],
                        names=["file", "y", "x", "lon", "lat", "bands"],
                    )

    return map_arrow(files, run, "file string, y bigint, x bigint, lon double, lat double, bands array<double>")


def images(blocks: DataFrame, size: int, west: float, north: float, res: float, nodata: float = -9999.0) -> DataFrame:
    """A GeoTIFF for each block of ``size`` by ``size`` cells (``y``, ``x``, ``bands``): ``by``, ``bx``, ``tiff``. A block, a fixed number of cells, is one group."""
    keyed = blocks.select(F.floor(F.col("y") / size).alias("by"), F.floor(F.col("x") / size).alias("bx"), "y", "x", "bands")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        by, bx = (k.as_py() for k in key)
        lists = table.column("bands").to_pylist()
        out = np.full((max(map(len, lists)), size, size), nodata)
        for y, x, bands in zip(table.column("y").to_pylist(), table.column("x").to_pylist(), lists):
            out[: len(bands), y - by * size, x - bx * size] = [nodata if v is None else v for v in bands]
        raster = Raster(out, west + bx * size * res, north - by * size * res, res, res, nodata)
        return pa.table({"by": [by], "bx": [bx], "tiff": pa.array([encode(raster)], pa.binary())})

    return group_arrow(keyed.groupBy("by", "bx"), run, "by bigint, bx bigint, tiff binary", blocks.sparkSession)
