"""Readers, ingest and text operators on small files of the kinds that a grid workflow meets, whole and broken."""

import json

import pytest
from pyspark.sql import functions as F

from gridweave.functions import geo, values
from gridweave.operators import catalog
from gridweave.sources import files, params

BOX = (32.62, -27.62, 32.82, -27.32)
SITE = "name string, n_dives int, verified boolean"
CLUSTERS = """cluster,candidate_reef,n_dives,centroid_lat,centroid_lon,max_depth_m,min_depth_m,elevation_m,alt_names
0, JosÃ© ,3.0,-27.4512345678,32.7012345678,21.5,8,0,"a, b"
1,UNNAMED,,-27.5,32.75,x,,0,
2,Far away,2,-10,32.7,5,1,0,
3,,1,-27.4,32.62,30.5,2.5,0,Ã©t
4,No place,1,,32.7,5,1,0,
"""


def feature(lon, lat, **properties):
    return {"type": "Feature", "geometry": {"type": "Point", "coordinates": [lon, lat]}, "properties": properties}


def test_sites_from_clusters(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CLUSTERS, encoding="utf-8")
    got = catalog.dive_sites(files.csv(spark, str(tmp_path / "c.csv")), BOX).collect()
    assert [r["name"] for r in got] == ["UNNAMED", "José", "UNNAMED"]
    assert [r["verified"] for r in got] == [False, True, False]
    second, last = got[1], got[2]
    assert (second["lon"], second["lat"], second["depth_min_m"], second["depth_max_m"], second["n_dives"], second["alt_names"]) == (32.701235, -27.451235, -21.5, -8.0, 3, "a, b")
    assert second["description"].startswith("José: ~22 m max, from 3.0 logged dive(s)") and last["description"].startswith("UNNAMED: depth n/a, from logged dive")
    assert (last["depth_min_m"], last["depth_max_m"], last["n_dives"]) == (None, None, 0) and got[0]["alt_names"] == "ét"


def test_broken_files_give_up_their_whole_features(spark, tmp_path):
    whole = json.dumps({"type": "FeatureCollection", "features": [feature(32.7, -27.5, reef="JosÃ©", cluster=i, max_depth_m=i + 0.5) for i in range(40)]}, indent=1)
    cut = whole[: whole.rindex('"cluster": 39')]
    (tmp_path / "p.geojson").write_bytes(cut.replace("\n", "\r\n").encode() + b"\xff")
    rows = files.geojson_tolerant(spark, str(tmp_path / "p.geojson"), "reef string, cluster int, max_depth_m double")
    got = rows.where(geo.in_box(F.col("lon"), F.col("lat"), BOX)).select(values.demojibake(F.col("reef")).alias("reef"), "cluster", (-F.abs("max_depth_m")).alias("d")).orderBy("cluster").collect()
    assert [tuple(r) for r in got] == [("José", i, -i - 0.5) for i in range(39)]
    (tmp_path / "q.geojson").write_text(whole)
    assert files.geojson_tolerant(spark, str(tmp_path / "q.geojson"), "cluster int").count() == 40


def test_other_files(spark, tmp_path):
    ring = [[32.62, -27.62], [32.82, -27.62], [32.82, -27.32], [32.62, -27.32], [32.62, -27.62]]
    (tmp_path / "a.geojson").write_text(json.dumps({"features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    assert files.box_of(spark, str(tmp_path / "a.geojson")) == BOX
    (tmp_path / "s.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature(1, 2, name="x", n_dives=3, verified=True), feature(1, 2, name="y", n_dives=4, verified=False)]}))
    sites = files.geojson(spark, str(tmp_path / "s.geojson"), SITE)
    assert (sites.count(), sites.where("verified").count(), sites.agg(F.sum("n_dives")).first()[0]) == (2, 1, 7)
    (tmp_path / "g.csv").write_text("# a note\nname,lat,lon,depth_m,tide_note\n# another\na,-27.5,32.7,-12,low\nb,,32.7,-1,\n")
    points = files.csv(spark, str(tmp_path / "g.csv"), "name string, lat double, lon double, depth_m double, tide_note string", "#", ("lat", "lon", "depth_m"))
    assert points.count() == 1
    (tmp_path / "p.yaml").write_text("model:\n  split_seed: 7\n  unknown: 1\ngates:\n  depth_bands_m: [0, 10, 20]\n")
    p = params.load(str(tmp_path / "p.yaml"))
    assert (p.split_seed, p.depth_bands_m, p.max_leads) == (7, (0, 10, 20), 100)
    assert catalog.match_headers(["Site_Name", "longitude", "Latitude ", "Depth-m", "depth"]) == {"name": "Site_Name", "lon": "longitude", "lat": "Latitude ", "depth_max_m": "depth"}


def test_broken_and_odd_geojson():
    whole = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":"}{"}}]}'
    assert len(files.salvage(whole)) == 1
    assert len(files.salvage(whole.replace("]}", ",{\"type\":\"Feature\",\"prop"))) == 1
    assert files.salvage("") == [] and files.salvage("{{{") == []


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def test_text_expressions(spark):
    assert one(spark, values.demojibake, "JosÃ©") == "José"
    assert one(spark, values.demojibake, "Wayneâ€™s") == "Wayneâ€™s"
    assert one(spark, values.demojibake, "José") == "José" and one(spark, values.demojibake, None) is None
    assert [one(spark, values.number_prefix, t) for t in ("1.5x", " -3e2m", "x1", "", ".5", None)] == [1.5, -300.0, None, None, 0.5, None]
    assert [one(spark, values.first_number, t) for t in ("about -12.5 m", "none", "")] == [-12.5, None, None]
    assert [one(spark, values.whole, t) for t in ("3.9", "", "x", None)] == [3, 0, 0, 0]
    assert one(spark, values.csv_field, 'a "b", c') == '"a ""b"", c"' and one(spark, values.csv_field, None) == ""
    assert one(spark, values.xml_escape, "a<&>'\"") == "a&lt;&amp;&gt;&apos;&quot;"
    assert one(spark, lambda c: values.minutes(c, "N", "S"), -27.5020, "double") == "S27°30.120'"
    assert one(spark, values.depth_label, 2.0, "double") == "−0.0 m" and one(spark, values.depth_label, None, "double") == "−"
    assert [one(spark, values.band, v, "double") for v in (-15.0, -25.0, -25.1, None)] == ["validated", "optical-wall", "coarse", None]
    assert one(spark, values.heading, 7.4, "double") == "007°"


def test_terrarium_keeps_heights(spark):
    rows = spark.createDataFrame([(float(v) / 7,) for v in range(-9000, 50)], "z double")
    r, g, b = values.terrarium(F.col("z"))
    worst = rows.select(F.max(F.abs(values.terrarium_height(r, g, b) - F.col("z")))).first()[0]
    assert worst <= 1 / 256


def test_import_with_quotes_blank_lines_and_bad_rows(spark, tmp_path):
    (tmp_path / "u.csv").write_text('Name,Latitude,LNG,Depth\n"Big, ""deep""",-27.5,32.7,12\n,-27.5x,32.7,\nx,99,32.7,5\ny,,32.7,5\n', encoding="utf-8")
    rows = files.csv(spark, str(tmp_path / "u.csv")).withColumn("n", F.monotonically_increasing_id())
    fields = catalog.match_headers(rows.columns)
    got = catalog.import_rows(rows, fields, "n", (32.62, -27.62, 32.82, -27.32)).orderBy("n").collect()
    assert [(r["accepted"], r["name"], r["depth_max_m"]) for r in got] == [(True, 'Big, "deep"', 12.0), (True, "Site 2", None), (False, None, 5.0), (False, None, 5.0)]


def test_documents(spark):
    sites = spark.createDataFrame([(1, "a<b", 32.7, -27.5, "12 m", "z", False, False, "o", ""), (2, "gone", 32.7, -27.5, "", "z", False, True, "o", "")], "id int, name string, lon double, lat double, depth string, zone string, renamed boolean, removed boolean, orig_name string, remarks string")
    text = catalog.gpx_text(catalog.gpx_waypoints(sites), "id").first()[0]
    assert text.count("<wpt ") == 1 and "<ele>-12.0</ele>" in text and "<name>a&lt;b</name>" in text
    collection = catalog.feature_collection(sites.withColumn("f", catalog.feature(F.col("lon"), F.col("lat"), F.struct("name"))), "f", "id", "sites").first()[0]
    assert len(json.loads(collection)["features"]) == 2
    assert catalog.csv_text(catalog.csv_lines(sites, ["id", "name"]), "id", ["id", "name"]).first()[0] == "id,name\r\n1,a<b\r\n2,gone"


def test_mojibake_repair_reads_whole_texts(spark, tmp_path, monkeypatch):
    from gridweave.plans import QUERIES

    texts = [(1, "a" * 300 + " José"), (2, "plain " * 100_000), (3, "é\n漢 " * 100_000), (4, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    repaired = lambda: {r["doc_id"]: r["repaired"] for r in QUERIES["mojibake_repair"](spark, str(tmp_path)).collect()}
    assert repaired() == {1: True, 2: True, 3: True, 4: None}
    monkeypatch.setattr(values, "demojibake", lambda x: x)  # nothing is put right: the character after many others shows it
    assert repaired() == {1: False, 2: True, 3: False, 4: None}
