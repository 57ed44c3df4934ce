"""GeoPackage layers: rows of an SQLite file with their geometries as rings or lines."""

from __future__ import annotations

import json
import sqlite3
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridweave.sources.workers import map_arrow

#: Bytes of the envelope after a geometry's header, by its kind (fixed values of the format).
ENVELOPES = (0, 32, 48, 48, 64)
KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}

Part = tuple[str, list[list[list[float]]]]


def _well_known(data: bytes, at: int) -> tuple[list[Part], int]:
    """Parts of a well-known-binary geometry: (kind, lists of points); a polygon's lists are its rings, outer first."""
    order = "<" if data[at] else ">"
    code = struct.unpack_from(order + "I", data, at + 1)[0]
    at += 5
    kind, dims = KINDS[code % 1000 & 0xFF], 2 + (code // 1000 % 4 in (1, 2)) + 2 * (code // 1000 == 3)

    def points(n: int, at: int) -> tuple[list[list[float]], int]:
        values = struct.unpack_from(f"{order}{n * dims}d", data, at)
        return [list(values[i : i + 2]) for i in range(0, n * dims, dims)], at + 8 * n * dims

    if kind == "Point":
        own, at = points(1, at)
        return [(kind, [own])], at
    count = struct.unpack_from(order + "I", data, at)[0]
    at += 4
    if kind == "LineString":
        own, at = points(count, at)
        return [(kind, [own])], at
    out: list[Part] = []
    if kind == "Polygon":
        rings = []
        for _ in range(count):
            n = struct.unpack_from(order + "I", data, at)[0]
            ring, at = points(n, at + 4)
            rings.append(ring)
        return [(kind, rings)], at
    for _ in range(count):
        parts, at = _well_known(data, at)
        out += parts
    return out, at


def geometry(blob: bytes) -> list[Part]:
    """Parts of a GeoPackage geometry; none for an empty one."""
    if blob[:2] != b"GP":
        raise ValueError("no GeoPackage geometry")
    flags = blob[3]
    return [] if flags >> 4 & 1 else _well_known(blob, 8 + ENVELOPES[flags >> 1 & 7])[0]


def layer(spark: SparkSession, path: str, name: str, column: str = "geom") -> DataFrame:
    """Parts of the geometries of a layer: ``id`` (row), ``part``, ``kind``, ``rings`` (lists of points), and ``properties``, a map of texts.

    Coordinates are returned as they are stored. A file is read whole by a task.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with sqlite3.connect(":memory:") as base:
                    base.deserialize(content.as_py())
                    rows = base.execute('SELECT rowid, * FROM "{}"'.format(name.replace('"', '""')))
                    columns = [c[0] for c in rows.description]
                    out = []
                    for row in rows:
                        values = dict(zip(columns[1:], row[1:]))
                        blob = values.pop(column, None)
                        texts = json.dumps({k: str(v) for k, v in values.items() if v is not None and not isinstance(v, bytes)})
                        out += [(row[0], i, kind, json.dumps(rings), texts) for i, (kind, rings) in enumerate(geometry(blob) if blob else [])]
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()))], names=["id", "part", "kind", "_r", "_p"])

    raw = map_arrow(files, run, "id bigint, part int, kind string, _r string, _p string")
    return raw.selectExpr("id", "part", "kind", "from_json(_r, 'array<array<array<double>>>') AS rings", "from_json(_p, 'map<string,string>') AS properties")
