"""Operators against brute force, and their edge cases."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.functions import geo, values
from gridweave.operators import fuse, graph, metrics, model, prospect, raster, routes, tiles, vector
from gridweave.sources import files
from gridweave.streaming import bands


def cells_of(spark, grid):
    rows = [(y, x, float(v)) for (y, x), v in np.ndenumerate(grid) if not np.isnan(v)]
    return spark.createDataFrame(rows, "y long, x long, z double")


def random_grid(height=14, width=11, holes=0.2, seed=3):
    rng = np.random.default_rng(seed)
    grid = rng.normal(-20, 5, (height, width))
    grid[rng.random((height, width)) < holes] = np.nan
    return grid


def as_grid(df, column, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["y"], r["x"]] = np.nan if r[column] is None else r[column]
    return out


@pytest.mark.parametrize("k", [3, 7])
def test_focal_means(spark, k):
    grid = random_grid()
    h = k // 2
    padded = np.pad(grid, h, constant_values=np.nan)
    want = np.array([[np.nanmean(padded[y : y + k, x : x + k]) if not np.isnan(grid[y, x]) else np.nan for x in range(grid.shape[1])] for y in range(grid.shape[0])])
    got = as_grid(raster.focal_mean(cells_of(spark, grid), k), "z_mean", grid.shape)
    np.testing.assert_allclose(got, want, atol=1e-9)
    filled = np.pad(np.nan_to_num(grid), h, mode="edge")
    want = np.array([[filled[y : y + k, x : x + k].mean() for x in range(grid.shape[1])] for y in range(grid.shape[0])])
    got = as_grid(raster.focal_mean_padded(cells_of(spark, grid), k, grid.shape[1], grid.shape[0]), "z_mean", grid.shape)
    np.testing.assert_allclose(got[~np.isnan(grid)], want[~np.isnan(grid)], atol=1e-9)


def test_slope_is_numpys_gradient(spark):
    grid = random_grid(holes=0)
    gy, gx = np.gradient(grid)
    got = as_grid(raster.slope(cells_of(spark, grid), grid.shape[1], grid.shape[0]), "slope", grid.shape)
    np.testing.assert_allclose(got, np.degrees(np.arctan(np.hypot(gx, gy))), atol=1e-9)


@pytest.mark.parametrize("n", [1, 3])
def test_erosion(spark, n):
    grid = random_grid(holes=0.03)
    ok = ~np.isnan(grid)
    for _ in range(n):
        p = np.pad(ok, 1)
        ok = p[1:-1, 1:-1] & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    got = {(r["y"], r["x"]) for r in raster.erode(cells_of(spark, grid), n).collect()}
    assert got == {tuple(map(int, p)) for p in np.argwhere(ok)}


def test_components(spark):
    grid = random_grid(20, 300, holes=0.45)
    labels = {}
    for y, x in np.argwhere(~np.isnan(grid)).tolist():
        if (y, x) in labels:
            continue
        todo, group = [(y, x)], []
        labels[(y, x)] = None
        while todo:
            a, b = todo.pop()
            group.append((a, b))
            for p in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if 0 <= p[0] < 20 and 0 <= p[1] < 300 and not np.isnan(grid[p]) and p not in labels:
                    labels[p] = None
                    todo.append(p)
        for p in group:
            labels[p] = min(a * 300 + b for a, b in group)
    got = {(r["y"], r["x"]): r["label"] for r in raster.label_components(cells_of(spark, grid).select("y", "x"), 300).collect()}
    assert got == labels


def test_component_chain_and_empty(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)}
    assert graph.connected_components(edges.limit(0)).count() == 0
    odd = spark.createDataFrame([(5, 5), (None, 1), (7, 3), (3, 7), (7, 9)], "a long, b long")
    assert sorted(map(tuple, graph.connected_components(odd).collect())) == [(3, 3), (7, 3), (9, 3)]


def test_nearest_fill(spark):
    grid = random_grid(holes=0.8)
    have = np.argwhere(~np.isnan(grid))
    got = {(r["y"], r["x"]): r["filled"] for r in raster.nearest_fill(cells_of(spark, grid), raster.dense(spark.createDataFrame([], "y long, x long"), 11, 14), 3).collect()}
    for (y, x), value in got.items():
        d = ((have - [y, x]) ** 2).sum(1)
        best = min(((int(a), *map(int, p)) for a, p in zip(d, have)), default=None)
        assert value == (pytest.approx(grid[best[1], best[2]]) if best and best[0] <= 9 else None)


def test_fusion_takes_the_first_tier(spark):
    grids = [random_grid(holes=h, seed=i) for i, h in enumerate((0.8, 0.5, 0.1))]
    fused = {(r["y"], r["x"]): (r["z"], r["source"]) for r in fuse.priority_fuse([(i, cells_of(spark, g)) for i, g in enumerate(grids)]).collect()}
    for place in np.ndindex(grids[0].shape):
        first = next(((pytest.approx(g[place]), i) for i, g in enumerate(grids) if not np.isnan(g[place])), None)
        assert fused.get(place) == first
    assert fuse.composition(spark.createDataFrame([], "source int")).count() == 0


def test_medians_exact_and_bounded(spark):
    points = spark.range(10_001).select((F.col("id") % 2).alias("c"), F.col("id").cast("double").alias("z"))
    exact = fuse.block_median(points, F.col("c"), F.lit(0), "z", least=5001).collect()
    near = fuse.block_median(points, F.col("c"), F.lit(0), "z", accuracy=200).orderBy("y").collect()
    assert [(r["y"], r["z"], r["n"]) for r in exact] == [(0, 5000.0, 5001)]
    assert [abs(r["z"] - 5000) < 100 for r in near] == [True, True]


def test_split_keeps_tracks_whole(spark):
    points = model.split(spark.range(2000).select((F.col("id") % 97).alias("track")))
    assert points.groupBy("track").agg(F.count_distinct("holdout").alias("n")).where("n > 1").count() == 0
    assert model.leaked(points.where("holdout"), points.where("NOT holdout")).count() == 0
    import hashlib

    for r in points.select("track", values.hash_share(F.col("track"), 42).alias("s")).distinct().collect():
        assert r["s"] == int(hashlib.md5(f"42:{r['track']}".encode()).hexdigest(), 16) % 10000 / 10000


def test_bands_and_gates(spark):
    pairs = spark.createDataFrame([(-14.0, -15.0), (-16.0, -15.0), (None, -3.0), (-3.0, None), (-26.0, -25.0)], "predicted double, observed double")
    got = {r["lo"]: r for r in metrics.band_metrics(pairs, (0, 15, 25, 30)).collect()}
    assert (got[0]["n"], got[15]["n"], got[25]["n"]) == (0, 2, 1) and got[0]["rmse"] is None and got[15]["rmse"] == 1 and got[15]["bias"] == 0
    gates = metrics.gates(pairs, [(0, 15, 1), (15, 25, 0.5), (25, 30, 1)])
    assert [r["status"] for r in gates.orderBy("lo").collect()] == ["N/A", "FAIL", "PASS"] and not metrics.passed(gates).first()[0]
    with pytest.raises(Exception, match="positive value over water"):
        metrics.assert_under_water(spark.createDataFrame([(1.0,)], "z double")).collect()


def test_nearest_match_ties_and_reach(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 500.0, 0.0)], "id int, px double, py double")
    sources = spark.createDataFrame([(9, 7.0, 10.0, 0.0), (3, 8.0, -10.0, 0.0)], "source_id int, payload double, px double, py double")
    got = {r["id"]: (r["source_id"], r["payload"], r["distance"]) for r in metrics.nearest_match(points, sources, 100.0).collect()}
    assert got == {1: (3, 8.0, 10.0), 2: (None, None, None)}


def test_nearest_site_both_ways(spark):
    points = spark.createDataFrame([(i, 32.6 + i * 0.013, -27.6 + i * 0.007) for i in range(30)], "id int, lon double, lat double")
    sites = spark.createDataFrame([(32.7, -27.5), (32.71, -27.4), (10.0, 5.0)], "lon double, lat double")
    small = {r["id"]: r["km"] for r in prospect.nearest_km(points, sites).collect()}
    large = {r["id"]: r["km"] for r in prospect.nearest_km(points, sites, most_sites=1).collect()}
    assert small == pytest.approx(large)
    assert {r["km"] for r in prospect.nearest_km(points, sites.limit(0)).collect()} == {999.0}


def test_grid_places(spark):
    grid = geo.Grid.metric(32.62, -27.62, 32.82, -27.32, 10)
    assert (grid.width, grid.height) == (2226, 3340)
    points = spark.createDataFrame([(32.62, -27.32), (32.8199, -27.6199), (32.5, -27.5), (32.7, -27.0)], "lon double, lat double")
    got = points.select(grid.row(F.col("lat")).alias("y"), grid.col(F.col("lon")).alias("x")).select("y", "x", grid.holds(F.col("y"), F.col("x")).alias("inside")).collect()
    assert [r["inside"] for r in got] == [True, True, False, False] and (got[0]["y"], got[0]["x"]) == (0, 0)
    ring = spark.range(1).select(geo.box_ring((0, 1, 2, 3))).first()[0]
    assert ring[0] == ring[-1] == [0.0, 1.0] and len(ring) == 5


def test_rings(spark):
    ring = F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in ((0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0))])
    points = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (5.0, 1.0)], "x double, y double")
    assert [r[0] for r in points.select(geo.in_ring(F.col("x"), F.col("y"), ring)).collect()] == [True, False, False]


def sampled_positions(way, spacing, most):
    """Positions by stepping along each leg, as a check."""

    def km(a, b):
        la, lb = np.radians([a[1], b[1]])
        h = np.sin((lb - la) / 2) ** 2 + np.cos(la) * np.cos(lb) * np.sin(np.radians(b[0] - a[0]) / 2) ** 2
        return 2 * 6371 * np.arcsin(np.sqrt(h))

    lengths = [1000 * km(a, b) for a, b in zip(way, way[1:])]
    step, before, out = max(spacing, sum(lengths) / most), 0.0, [0.0]
    for length in lengths if sum(lengths) else []:
        k = int(np.ceil((before + 1e-6) / step))
        while length > 0 and k * step - before < length - 1e-6:
            out.append(k * step)
            k += 1
        before += length
        out.append(before)
    return out


def test_route_samples(spark):
    rng = np.random.default_rng(4)
    ways = [[(32.7 + a, -27.5 + b) for a, b in rng.normal(0, 0.01, (n, 2))] for n in (1, 2, 5, 9)] + [[(32.7, -27.5)] * 3]
    rows = [(r, i, *map(float, p)) for r, way in enumerate(ways) for i, p in enumerate(way)]
    got = routes.samples(spark.createDataFrame(rows, "route int, idx int, lon double, lat double"), 100.0, 50).orderBy("route", "n").collect()
    for r, way in enumerate(ways):
        assert [s["d"] for s in got if s["route"] == r] == pytest.approx(sampled_positions(way, 100.0, 50), abs=1e-6)


def test_reports(spark):
    way = spark.createDataFrame([(1, 0, 32.7, -27.5), (1, 1, 32.71, -27.5), (2, 0, 32.7, -27.5)], "route int, idx int, lon double, lat double")
    profile = routes.samples(way, 200.0).withColumn("depth", F.when(F.col("n") != 1, -F.col("n") * 10.0)).withColumn("band", values.band(F.col("depth")))
    text = {r["route"]: r["report"] for r in routes.report(way, routes.summary(profile), routes.bands_crossed(profile)).collect()}
    assert "Leg 1 -> 2: heading 090°" in text[1] and "lower-confidence" in text[1] and "Legs:" not in text[2]
    assert routes.svg(profile).where("svg LIKE '<svg%polyline%'").count() == 2


def test_tiles(spark):
    box = (32.62, -27.62, 32.82, -27.32)
    assert tiles.count(spark, box, 8, 15).agg(F.sum("tiles")).first()[0] == 840
    assert tiles.cover(spark, box, 8, 12).count() == 1 + 1 + 4 + 6 + 15
    grid = geo.Grid(*box, 0.01, north_up=False)
    ground = spark.createDataFrame([(y, x, -5.0) for y in range(15) for x in range(20)], "y long, x long, z double")
    shown = tiles.rendered(tiles.cover(spark, box, 9, 9), ground, grid, 16, alpha=True)
    image = tiles.images(shown, 16).first()["png"]
    assert image[:8] == b"\x89PNG\r\n\x1a\n" and len(zlib.decompress(image[41 : 41 + int.from_bytes(image[33:37], "big")])) == 16 * (16 * 4 + 1)
    assert tiles.rendered(tiles.cover(spark, box, 9, 9), ground.limit(0), grid, 4).count() == 0


def test_clip_simplify_densify(spark):
    square = np.array([[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], float)
    cut = vector.clip_ring(square, (1, 1, 9, 3))
    x, y = cut[:-1].T
    assert abs(np.dot(x, np.roll(y, 1)) - np.dot(y, np.roll(x, 1))) / 2 == pytest.approx(6)
    assert len(vector.clip_ring(square, (5, 5, 9, 9))) == 0
    df = spark.createDataFrame([(1, square.tolist()), (2, (square + 50).tolist())], "id int, ring array<array<double>>")
    assert [r["id"] for r in vector.clip_polygons(df, (1, 1, 9, 3)).collect()] == [1]
    line = np.array([[0, 0], [1, 0.001], [2, 0], [3, 1], [4, 0]], float)
    assert len(vector.simplify_line(line, 0.01)) == 4
    lines = spark.createDataFrame([(1, line.tolist()), (2, [[0.0, 0.0], [1.0, 0.0]])], "id int, line array<array<double>>")
    assert vector.simplify(lines, 0.01).count() == 2
    dense = vector.densify(lines, 0.1).orderBy("id", "k").collect()
    second = [(r["x"], r["y"]) for r in dense if r["id"] == 2]
    np.testing.assert_allclose(second, [(i / 11, 0.0) for i in range(12)], atol=1e-12)
    length = np.hypot(*np.diff(line, axis=0).T).sum()
    first = np.array([(r["x"], r["y"]) for r in dense if r["id"] == 1])
    assert len(first) == int(length / 0.1) + 2 and first[0].tolist() == [0, 0] and first[-1].tolist() == pytest.approx([4, 0])


def test_interpolation_is_exact_on_planes():
    rng = np.random.default_rng(5)
    points = rng.random((200, 2))
    targets = rng.random((300, 2)) * 1.2 - 0.1
    got = vector.interpolate(points, points @ [2.0, -3.0] + 1, targets)
    inside = ~np.isnan(got)
    np.testing.assert_allclose(got[inside], (targets @ [2.0, -3.0] + 1)[inside], atol=1e-9)
    assert 0.5 < inside.mean() < 1 and len(vector.triangulate(points)) < 400
    assert np.isnan(vector.interpolate(points[:2], points[:2, 0], targets)).all()


def test_trees_beat_the_mean(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i % 40), *map(float, rng.uniform(0.01, 0.3, 5))) for i in range(1500)]
    pixels = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, track int, b1 double, b2 double, b3 double, b4 double, b8 double")
    known = model.split(model.features(pixels).withColumn("depth", -F.col("ratio_b2_b3") * 8))
    fitted = model.fit_trees(known.where("NOT holdout"), "depth", rounds=10, depth=4, step=0.3)
    scored = model.predict(fitted, known.where("holdout"), ["id"], floor=-1e9).select(F.sqrt(F.avg(F.pow(F.col("predicted") - F.col("depth"), 2))), F.stddev("depth")).first()
    assert scored[0] < scored[1]
    about = model.summary(fitted, known.where("NOT holdout"), model.baseline(known.where("NOT holdout"), "stumpf", "depth")).first()
    assert about["n_train"] == known.where("NOT holdout").count() and about["model"] == "GBTRegressor(10)" and len(about["features"]) == 7


def test_stream_gives_the_tables_bands(spark, tmp_path):
    rows = spark.range(500).select(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 900).alias("ts"), (-F.col("id") % 40).cast("double").alias("depth_m"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = bands.windowed_bands(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    run = stream.writeStream.outputMode("complete").format("memory").queryName("bands").start()
    run.processAllAvailable()
    run.stop()
    assert sorted(map(tuple, spark.table("bands").collect()), key=str) == sorted(map(tuple, bands.windowed_bands(rows).collect()), key=str)


def test_writers(spark, tmp_path):
    ground = spark.createDataFrame([(y, x, -1.0) for y in range(4) for x in range(4)], "y long, x long, z double")
    files.write_cells(ground, str(tmp_path / "c"), 2)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 16
    files.write_points(ground.withColumn("holdout", F.col("y") > 2), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).where("holdout = 'true'").count() == 4
    files.write_csv(ground, str(tmp_path / "v"))
    assert files.csv(spark, str(tmp_path / "v")).count() == 16
    (tmp_path / "t.tif").write_bytes(b"II*\0" + bytes(2000))
    (tmp_path / "u.tif").write_bytes(b"<html>" + bytes(2000))
    assert {r["path"][-5:]: r["tiff"] for r in files.is_tiff(spark, str(tmp_path / "*.tif")).collect()} == {"t.tif": True, "u.tif": False}
    edits = spark.createDataFrame([('{"a":{"name":"n"},"b":{"removed":true}}',)], "t string")
    assert sorted(map(tuple, files.backup_edits(edits, "t").collect()), key=str) == [("a", "n", None), ("b", None, True)]


def test_components_with_hubs(spark):
    """Nodes with many edges are broadcast, others joined: the same components either way, for stars, chains and random graphs."""
    import random

    from gridweave.operators.graph import connected_components

    rng = random.Random(4)
    pairs = [(0, n) for n in range(1, 60)] + [(500 - n, 500) for n in range(40)] + [(n, n + 1) for n in range(600, 660)]
    pairs += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(7, 480), (3, 3), (None, 4)]
    top = {}

    def find(n):
        while top.setdefault(n, n) != n:
            n = top[n]
        return n

    for a, b in pairs:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            top[high] = low
    want = {n: find(n) for n in top}
    edges = spark.createDataFrame(pairs, "a long, b long")
    for heavy in (0, 5, 1000):
        assert {r["node"]: r["component"] for r in connected_components(edges, heavy=heavy).collect()} == want


def test_nearest_site_across_the_antimeridian_and_poles(spark):
    """Rings of buckets give what comparing with every site gives, on both sides of 180 degrees and near the poles."""
    import random

    from gridweave.operators.prospect import nearest_km

    rng = random.Random(8)
    sites = [(179.0, 0.0), (-179.99, 0.0), (10.0, 89.9), (-170.0, 89.95), (0.0, -89.0)] + [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(40)]
    points = [(0, 179.99, 0.0), (1, -180.0, 0.0), (2, 180.0, 0.0), (3, 100.0, 90.0), (4, -100.0, 89.99), (5, 179.0, -89.9)] + [(6 + i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(60)]
    p, s = spark.createDataFrame(points, "id int, lon double, lat double"), spark.createDataFrame(sites, "lon double, lat double")
    whole, rings = ({r["id"]: r["km"] for r in nearest_km(p, s, most_sites=n).collect()} for n in (1000, 0))
    assert set(whole) == set(rings) and all(abs(whole[i] - rings[i]) < 1e-6 for i in whole) and whole[0] < 3


def test_sites_in_one_place_count_once(spark, monkeypatch):
    """Thousands of sites in three places are three places, not a case for rings of buckets."""
    monkeypatch.setattr(prospect, "ringed_km", None, raising=False)
    sites = spark.range(5000).select((F.col("id") % 3 * 0.5).alias("lon"), F.lit(0.0).alias("lat"))
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.6, 0.0), (3, None, 0.0)], "id int, lon double, lat double")
    near = prospect.nearest_km(points, sites)
    assert {r["id"]: round(r["km"], 3) for r in near.collect()} == {1: 0.0, 2: 11.119, 3: 20015.087}
    assert "Generate explode" not in near._jdf.queryExecution().toString()


def test_rings_of_sites_are_never_broadcast(spark, monkeypatch):
    """Nine buckets for each site: Spark takes them for as small as the sites' file, and the driver would hold them all."""
    plans = []
    real = prospect.written
    monkeypatch.setattr(prospect, "written", lambda df, name="table": (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), real(df, name))[1])
    sites = spark.range(3000).select((F.col("id") * 0.001).alias("lon"), F.lit(0.0).alias("lat"))
    points = spark.createDataFrame([(1, 0.0004, 0.0), (2, 40.0, 0.0), (3, None, 0.0)], "id int, lon double, lat double")
    got = {r["id"]: r["km"] for r in prospect.nearest_km(points, sites, most_sites=100).collect()}
    assert got == pytest.approx({1: 0.0004 * 111.1949, 2: (40 - 2.999) * 111.1949, 3: 20015.0868}, rel=1e-5)
    rings = [plan for name, plan in plans if name == "nearest"]
    assert rings and all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in rings)


@pytest.mark.parametrize("held", [0, 200_000])
def test_listed_places_are_those_of_brute_force(spark, held):
    """A square's list holds the nearest place of each point in it, around the globe, at its edges and where points are odd."""
    import random

    rng = random.Random(3)
    places = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(30)] + [(32.62 + i % 8 * 0.003, -27.62 + i // 8 * 0.004) for i in range(60)] + [(180.0, 0.0), (-180.0, 89.99), (0.0, -90.0)]
    spots = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(40)] + [(32.60 + rng.random() * 0.06, -27.63 + rng.random() * 0.06) for _ in range(200)] + [(32.61, -27.61), (-179.999, 0.001), (50.0, 90.0), (190.0, -90.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)] + [(-1, None, 1.0), (-2, 1.0, None)], "id int, lon double, lat double")
    got = {r["id"]: r["km"] for r in prospect.listed_km(points, spark.createDataFrame(places, "lon double, lat double"), 999.0, most_held=held).collect()}

    def km(p, s):
        a = math.sin(math.radians(s[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(s[1])) * math.sin(math.radians(s[0] - p[0]) / 2) ** 2
        return 12742 * math.asin(math.sqrt(min(a, 1)))

    assert got == pytest.approx({i: min(km(p, s) for s in places) for i, p in enumerate(spots)} | {-1: 6371 * math.pi, -2: 6371 * math.pi}, abs=1e-6)
