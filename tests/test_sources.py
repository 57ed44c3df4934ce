"""Sources and small operators: GeoTIFF, GeoPackage, JSON documents, imports, edits, reports."""

import json
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.functions import values
from gridweave.operators import catalog, metrics, routes, vector
from gridweave.sources import files, geopackage, geotiff


def test_geotiff_round_trip(spark, tmp_path):
    rng = np.random.default_rng(1)
    bands = rng.normal(-20, 5, (2, 37, 53)).astype("f4")
    bands[:, rng.random((37, 53)) < 0.3] = -9999
    data = geotiff.encode(geotiff.Raster(bands, 32.62, -27.32, 0.01, 0.01, -9999.0))
    back = geotiff.parse(data)
    np.testing.assert_array_equal(back.bands, bands)
    assert (back.west, back.north, back.width, back.nodata) == (32.62, -27.32, 0.01, -9999.0)
    (tmp_path / "a.tif").write_bytes(data)
    got = geotiff.cells(spark, str(tmp_path / "a.tif"))
    assert got.count() == (bands[0] != -9999).sum() and files.is_tiff(spark, str(tmp_path / "a.tif")).first()["tiff"]
    r = got.where("y = 5").orderBy("x").first()
    assert r["bands"] == pytest.approx(bands[:, 5, r["x"]].tolist()) and r["lat"] == pytest.approx(-27.32 - 5.5 * 0.01)
    blocks = geotiff.images(got, 32, 32.62, -27.32, 0.01).collect()
    assert {(b["by"], b["bx"]) for b in blocks} == {(0, 0), (0, 1), (1, 0), (1, 1)}
    corner = geotiff.parse(bytes(next(b["tiff"] for b in blocks if (b["by"], b["bx"]) == (1, 1))))
    np.testing.assert_array_equal(corner.bands[0, :5, :21], bands[0, 32:, 32:])


def tiff(order, kind, values, tiled):
    """A one-band file of big- or little-endian values, in strips or tiles, as another program might write it."""
    h, w = values.shape
    whole = np.pad(values, ((0, 32 - h), (0, 32 - w)))
    parts = [whole[y : y + 16, x : x + 16] for y in (0, 16) for x in (0, 16)] if tiled else [values[i : i + 8] for i in range(0, h, 8)]
    raw = [p.astype(f"{order}{kind}").tobytes() for p in parts]
    starts = np.cumsum([8, *map(len, raw)])[:-1].tolist()
    tags = [(256, 3, [w]), (257, 3, [h]), (258, 3, [int(kind[1]) * 8]), (259, 3, [1]), (277, 3, [1]), (339, 3, [{"i": 2, "u": 1, "f": 3}[kind[0]]])]
    tags += [(322, 3, [16]), (323, 3, [16]), (324, 4, starts), (325, 4, list(map(len, raw)))] if tiled else [(273, 4, starts), (278, 3, [8]), (279, 4, list(map(len, raw)))]
    at = 8 + sum(map(len, raw))
    head, extra, after = b"", b"", at + 2 + 12 * len(tags) + 4
    for tag, t, v in sorted(tags):
        packed = struct.pack(f"{order}{len(v)}{'H' if t == 3 else 'I'}", *v)
        head += struct.pack(order + "HHI", tag, t, len(v)) + (packed.ljust(4, b"\0") if len(packed) <= 4 else struct.pack(order + "I", after + len(extra)))
        extra += packed if len(packed) > 4 else b""
    return (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, at) + b"".join(raw) + struct.pack(order + "H", len(tags)) + head + b"\0" * 4 + extra


@pytest.mark.parametrize("order", "<>")
@pytest.mark.parametrize("kind", ["i2", "f8", "u1"])
@pytest.mark.parametrize("tiled", [False, True])
def test_geotiffs_of_others(order, kind, tiled):
    grid = np.arange(20 * 24).reshape(20, 24) % 200
    np.testing.assert_array_equal(geotiff.parse(tiff(order, kind, grid, tiled)).bands[0], grid)
    with pytest.raises(ValueError):
        geotiff.parse(b"GIF89a" + bytes(40))


def wkb(kind, *rings):
    body = struct.pack("<BI", 1, kind)
    if kind == 3:
        body += struct.pack("<I", len(rings))
    for ring in rings:
        body += struct.pack(f"<I{2 * len(ring)}d", len(ring), *[v for p in ring for v in p])
    return body


def test_geopackage(spark, tmp_path):
    square, line = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)], [(5.0, 5.0), (6.0, 7.0)]
    base = sqlite3.connect(tmp_path / "g.gpkg")
    base.execute("CREATE TABLE soil (fid INTEGER PRIMARY KEY, geology TEXT, geom BLOB)")
    head = b"GP\0\x01" + struct.pack("<i", 4326)
    boxed = b"GP\0\x03" + struct.pack("<i4d", 4326, 0, 1, 0, 1)
    multi = struct.pack("<BII", 1, 5, 2) + wkb(2, line) + wkb(2, line[::-1])
    base.executemany("INSERT INTO soil (geology, geom) VALUES (?, ?)", [("Reef", head + wkb(3, square)), (None, boxed + wkb(2, line)), ("M", head + multi), ("no", None)])
    base.commit()
    base.close()
    got = geopackage.layer(spark, str(tmp_path / "g.gpkg"), "soil").orderBy("id", "part").collect()
    assert [(r["id"], r["part"], r["kind"], len(r["rings"][0]), r["properties"].get("geology")) for r in got] == [(1, 0, "Polygon", 4, "Reef"), (2, 0, "LineString", 2, None), (3, 0, "LineString", 2, "M"), (3, 1, "LineString", 2, "M")]
    assert vector.line_parts(geopackage.layer(spark, str(tmp_path / "g.gpkg"), "soil")).count() == 3


def test_documents_and_edits(spark, tmp_path):
    (tmp_path / "flags.json").write_text('{"a": false}')
    assert files.flags(spark, str(tmp_path / "flags.json")).first()["flags"] == {"a": False} and files.flags(spark, str(tmp_path / "none.json")).first()["flags"] == {}
    assert files.first_existing(spark, [str(tmp_path / "x"), str(tmp_path / "flags.json")]).endswith("flags.json") and files.first_existing(spark, []) is None
    (tmp_path / "p.json").write_text(json.dumps([{"id": "1", "suggestedName": "A", "flags": ["error"], "lat": 1.0}]))
    assert files.editor_points(spark, str(tmp_path / "p.json")).where(F.array_contains("flags", "error")).first()["suggested"] == "A"
    sites = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    changed = catalog.apply_edits(sites, spark.createDataFrame([(2, "B"), (4, "d")], "id int, name string"), spark.createDataFrame([(1,)], "id int"))
    assert sorted(map(tuple, changed.collect())) == [(2, "B"), (3, "c"), (4, "d")]
    assert catalog.selected(sites, spark.createDataFrame([(3,)], "id int")).count() == 1


def test_feature_import(spark):
    point = lambda lon, lat, **p: {"type": "Feature", "geometry": {"type": "Point", "coordinates": [lon, lat]}, "properties": p}
    texts = [json.dumps({"type": "FeatureCollection", "features": [point(32.7, -27.5, name="A", depth_max_m=-12), point(32.7, -27.5), {"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}, "properties": {}}, point(0, 0)]}), json.dumps(point(32.7, -27.4)), '{"type": "Other"}', "broken"]
    box = (32.62, -27.62, 32.82, -27.32)
    totals = []
    for text in texts:
        got = catalog.import_features(spark.createDataFrame([(text,)], "t string"), "t", box)
        totals.append(tuple(catalog.import_totals(got).first()))
    assert totals == [(2, 2, 4), (1, 0, 1), (0, 0, 0), (0, 0, 0)]
    first = catalog.import_features(spark.createDataFrame([(texts[0],)], "t string"), "t", box).orderBy("n").collect()
    assert [(r["name"], r["depth_max_m"]) for r in first[:2]] == [("A", -12.0), ("Site 2", None)]


def test_reports_and_measures(spark):
    pairs = spark.createDataFrame([(-14.0, -12.0), (-16.0, -18.0)], "predicted double, observed double")
    text = metrics.report(metrics.band_metrics(pairs, (0, 15, 25)), metrics.gates(pairs, [(0, 15, 1.5), (15, 25, 2.5)])).first()[0]
    assert "| 0-15 m | 1 | 2.00 | 2.00 |" in text and "- 0-15 m: FAIL (RMSE 2.00, at most 1.50)" in text and "15-25 m: PASS" in text
    way = spark.createDataFrame([(1, 0, 32.7, -27.5), (1, 1, 32.71, -27.5), (1, 2, 32.71, -27.4)], "route int, idx int, lon double, lat double")
    got = routes.measure(way).first()
    assert got["metres"] == pytest.approx(12105, abs=10) and got["bearing"] == pytest.approx(0, abs=1e-6)
    assert spark.range(1).select(F.length(values.stable_id(F.lit("a"), F.lit("b"))), F.length(values.date_stamp()), F.length(values.new_id())).first() == (16, 10, 36)


def netcdf(version, record):
    """A file with latitudes, longitudes and heights, the latter along a growing dimension if ``record``."""
    count = ">q" if version == 5 else ">i"
    pad = lambda b: b + bytes(-len(b) % 4)
    name = lambda s: struct.pack(count, len(s)) + pad(s.encode())
    none = struct.pack(">i", 0) + struct.pack(count, 0)
    lat, lon = np.array([-27.0, -27.5], ">f8"), np.array([32.0, 32.5, 33.0], ">f4")
    z = np.array([[1, -99, 3], [4, 5, 6]], ">i2")
    attributes = struct.pack(">i", 12) + struct.pack(count, 2) + name("_FillValue") + struct.pack(">i", 3) + struct.pack(count, 1) + pad(struct.pack(">h", -99)) + name("scale_factor") + struct.pack(">i", 6) + struct.pack(count, 1) + struct.pack(">d", 0.5)
    parts = [("lat", [0], none, 6, lat), ("lon", [1], none, 5, lon), ("z", [0, 1], attributes, 3, z)]
    fixed = [p for p in parts if not (record and p[1][0] == 0)]
    moving = [p for p in parts if record and p[1][0] == 0]
    sizes = {p[0]: len(pad(p[4].tobytes() if p in fixed else p[4][:1].tobytes())) for p in parts}

    def header(begins):
        out = b"CDF" + bytes([version]) + struct.pack(count, 2 if record else 0) + struct.pack(">i", 10) + struct.pack(count, 2)
        out += name("lat") + struct.pack(count, 0 if record else 2) + name("lon") + struct.pack(count, 3) + none + struct.pack(">i", 11) + struct.pack(count, 3)
        for n, dims, atts, kind, _ in parts:
            out += name(n) + struct.pack(count, len(dims)) + b"".join(struct.pack(count, d) for d in dims) + atts + struct.pack(">i", kind) + struct.pack(count, sizes[n]) + struct.pack(">i" if version == 1 else ">q", begins[n])
        return out

    at = len(header(dict.fromkeys(sizes, 0)))
    begins, body = {}, b""
    for p in fixed:
        begins[p[0]] = at + len(body)
        body += pad(p[4].tobytes())
    for p in moving:
        begins[p[0]] = at + len(body) + sum(sizes[q[0]] for q in moving[: moving.index(p)])
    for i in range(2 if record else 0):
        body += b"".join(pad(p[4][i : i + 1].tobytes()) for p in moving)
    return header(begins) + body


@pytest.mark.parametrize("version", [1, 2, 5])
@pytest.mark.parametrize("record", [False, True])
def test_netcdf(spark, tmp_path, version, record):
    from gridweave.sources import netcdf as source

    (tmp_path / "a.nc").write_bytes(netcdf(version, record))
    got = {(r["y"], r["x"]): (r["lon"], r["lat"], r["z"]) for r in source.cells(spark, str(tmp_path / "a.nc"), "z").collect()}
    assert got == {(0, 0): (32.0, -27.0, 0.5), (0, 2): (33.0, -27.0, 1.5), (1, 0): (32.0, -27.5, 2.0), (1, 1): (32.5, -27.5, 2.5), (1, 2): (33.0, -27.5, 3.0)}
    with pytest.raises(ValueError):
        source.variables(b"\x89HDF\r\n\x1a\n")


def test_tables_are_made_once_and_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    assert files.produce(spark, path, lambda: spark.range(3), dry_run=True) is None and not files.exists(spark, path)
    assert files.produce(spark, path, lambda: spark.range(3)).count() == 3
    assert files.produce(spark, path, lambda: spark.range(9)).count() == 3
    assert files.produce(spark, path, lambda: spark.read.parquet(path).where("id > 0"), force=True).count() == 2
    with pytest.raises(Exception, match="broken"):
        files.produce(spark, path, lambda: spark.range(1).selectExpr("raise_error('broken') AS id"), force=True)
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir() if ".old-" in p.name] == []
