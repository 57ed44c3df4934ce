"""Registered queries on points and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridweave.functions import geo, values
from gridweave.operators import fuse, metrics, model, prospect, raster, tiles
from gridweave.plans.relations import BOX, EDGES, GRID, cells, query, soundings, table
from gridweave.sources import files

R6 = lambda c, name=None: F.round(c, 6).alias(name or c)


def tracked(spark, sf):
    return model.split(soundings(spark, sf))


def tiers(spark, sf):
    known = tracked(spark, sf).where("NOT holdout")
    part = lambda rows: fuse.block_median(rows, F.col("y"), F.col("x"), "depth_m").select("y", "x", "z")
    return [(1, part(known.where("event_type = 'purchase'"))), (4, part(known.where("event_type = 'view' AND x < 15"))), (7, part(known))]


def sampled(spark, sf):
    """Held-out points with the fused value of their cell."""
    points = tracked(spark, sf).where("holdout").drop("y", "x")
    return raster.sample(points, fuse.priority_fuse(tiers(spark, sf)), GRID.row(F.col("lat")), GRID.col(F.col("lon")))


def bands_sql(edges, rows, observed="depth_m", predicted="z"):
    lo = ", ".join(f"({float(a)}::DOUBLE, {float(b)}::DOUBLE)" for a, b in zip(edges, edges[1:]))
    return f"""SELECT b.lo, b.hi, count(p.e)::BIGINT AS n, round(sqrt(avg(p.e * p.e)), 6) AS rmse, round(avg(abs(p.e)), 6) AS mae, round(avg(p.e), 6) AS bias
    FROM (VALUES {lo}) b(lo, hi) LEFT JOIN (SELECT abs({observed}) AS d, {predicted} - {observed} AS e FROM {rows} WHERE {predicted} - {observed} IS NOT NULL) p ON p.d >= b.lo AND p.d < b.hi GROUP BY b.lo, b.hi"""


HELD = "AND , held AS (SELECT tr.*, fused.z FROM tr LEFT JOIN fused USING (y, x) WHERE holdout) "


@query("fused_band_accuracy", HELD + bands_sql(EDGES, "held"))
def fused_band_accuracy(spark, sf):
    """Train tracks gridded and fused in three tiers, sampled at held-out points, and measured by depth band."""
    return metrics.band_metrics(sampled(spark, sf), EDGES, "z", "depth_m").select("lo", "hi", "n", R6("rmse"), R6("mae"), R6("bias"))


@query("block_median", "SELECT y, x, z, n FROM g")
def block_median(spark, sf):
    return cells(spark, sf)


@query("median_composite", "SELECT l_partkey % 500 AS y, l_suppkey % 50 AS x, round(median(nullif(l_quantity, 1)), 6) AS b1, round(median(l_extendedprice), 6) AS b2, round(median(nullif(l_discount, 0)), 6) AS b3 FROM lineitem GROUP BY ALL", bare=True)
def median_composite(spark, sf):
    """Line items as scene pixels: the day is the scene, part and supplier give the cell, a value of no worth is nodata."""
    scenes = table(spark, sf, "lineitem").select((F.col("l_partkey") % 500).alias("y"), (F.col("l_suppkey") % 50).alias("x"), F.nullif("l_quantity", F.lit(1.0)).alias("b1"), F.col("l_extendedprice").alias("b2"), F.nullif("l_discount", F.lit(0.0)).alias("b3"))
    return fuse.composite(scenes, ["y", "x"], ["b1", "b2", "b3"]).select("y", "x", R6("b1"), R6("b2"), R6("b3"))


@query("priority_fuse", "SELECT y, x, z, source::INTEGER AS source FROM fused")
def priority_fuse(spark, sf):
    return fuse.priority_fuse(tiers(spark, sf))


@query("source_composition", "SELECT source::INTEGER AS source, count(*)::BIGINT AS cells, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS percent FROM fused GROUP BY source")
def source_composition(spark, sf):
    return fuse.composition(fuse.priority_fuse(tiers(spark, sf))).select("source", "cells", R6("percent"))


@query("uncertainty_lookup", "SELECT y, x, z, source::INTEGER AS source, CASE source WHEN 1 THEN 0.5::DOUBLE WHEN 4 THEN 1.5::DOUBLE END AS sigma FROM fused")
def uncertainty_lookup(spark, sf):
    return fuse.uncertainty(fuse.priority_fuse(tiers(spark, sf)), {1: 0.5, 4: 1.5})


@query("land_mask", "SELECT y, x, z, n FROM g WHERE NOT ((y * 31 + x * 17) % 100 / 1000.0::DOUBLE > 0.06::DOUBLE)")
def land_mask(spark, sf):
    ground = cells(spark, sf)
    return fuse.mask_land(ground, ground.select("y", "x", (F.pmod(F.col("y") * 31 + F.col("x") * 17, F.lit(100)) / F.lit(1000.0)).alias("nir")))


@query("band_override", "SELECT y, x, t2.z AS base, t0.z AS other, CASE WHEN t2.z BETWEEN -200 AND -50 AND t0.z IS NOT NULL THEN t0.z ELSE t2.z END AS fused, t2.z BETWEEN -200 AND -50 AND t0.z IS NOT NULL AS overridden FROM t2 LEFT JOIN t0 USING (y, x)")
def band_override(spark, sf):
    first, _, last = (c for _, c in tiers(spark, sf))
    both = last.withColumnRenamed("z", "base").join(first.withColumnRenamed("z", "other"), ["y", "x"], "left")
    return fuse.override_in_band(both, "base", "other", -200.0, -50.0)


@query("datum_align", "SELECT count(CASE WHEN t2.z BETWEEN -200 AND -5 AND t0.z IS NOT NULL THEN 1 END)::BIGINT AS n, CASE WHEN count(CASE WHEN t2.z BETWEEN -200 AND -5 AND t0.z IS NOT NULL THEN 1 END) >= 50 THEN median(CASE WHEN t2.z BETWEEN -200 AND -5 THEN t2.z - t0.z END) ELSE 0.0 END AS \"offset\" FROM t2 LEFT JOIN t0 USING (y, x)")
def datum_align(spark, sf):
    first, _, last = (c for _, c in tiers(spark, sf))
    return fuse.datum_offset(last.withColumnRenamed("z", "a").join(first.withColumnRenamed("z", "b"), ["y", "x"], "left"), "a", "b", -200.0, -5.0, 50)


@query("track_split", "SELECT track, share, share < 0.3::DOUBLE AS holdout FROM hs")
def track_split(spark, sf):
    tracks = soundings(spark, sf).select("track").distinct()
    return model.split(tracks).withColumn("share", values.hash_share(F.col("track"), 42)).select("track", "share", "holdout")


@query("split_semi_anti", "SELECT holdout, count(*)::BIGINT AS points, count(DISTINCT track)::BIGINT AS tracks, 0::BIGINT AS leaked FROM tr GROUP BY holdout")
def split_semi_anti(spark, sf):
    points = tracked(spark, sf)
    train, held = points.where("NOT holdout"), points.where("holdout")
    leaks = model.leaked(train, held).agg(F.count(F.lit(1)).alias("leaked"))
    return points.groupBy("holdout").agg(F.count(F.lit(1)).alias("points"), F.count_distinct("track").alias("tracks")).crossJoin(F.broadcast(leaks))


@query("confidence_filter", "SELECT event_id, confidence, lon, lat, depth_m FROM s0 WHERE confidence >= CASE event_type WHEN 'view' THEN 0.3::DOUBLE WHEN 'click' THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END AND lat IS NOT NULL AND lon IS NOT NULL AND depth_m IS NOT NULL")
def confidence_filter(spark, sf):
    label = F.when(F.col("event_type") == "view", "low").when(F.col("event_type") == "click", "high").otherwise("medium")
    return soundings(spark, sf).where(F.col("confidence") >= values.confidence_floor(label)).na.drop(subset=["lat", "lon", "depth_m"]).select("event_id", "confidence", "lon", "lat", "depth_m")


@query("track_ids", "SELECT event_id, concat_ws('-', user_id::VARCHAR, (event_id % 7)::VARCHAR, coalesce(CASE WHEN event_id % 3 = 0 THEN (event_id % 5)::VARCHAR END, CASE WHEN event_id % 2 = 0 THEN 'gt1l' END, '?')) AS track FROM events", bare=True)
def track_ids(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", model.track_id(F.col("user_id"), F.col("event_id") % 7, F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 5), F.when(F.col("event_id") % 2 == 0, "gt1l")).alias("track"))


@query("track_lines", "SELECT track, count(*)::BIGINT AS n, md5(string_agg(event_id::VARCHAR, ',' ORDER BY lat, event_id)) AS line FROM s0 GROUP BY track HAVING count(*) >= 2")
def track_lines(spark, sf):
    """Tracks of two or more points as lines from south to north; the order is returned as a digest."""
    ordered = F.array_sort(F.collect_list(F.struct("lat", "event_id")))
    lines = soundings(spark, sf).groupBy("track").agg(F.count(F.lit(1)).alias("n"), ordered.alias("p")).where("n >= 2")
    return lines.select("track", "n", F.md5(F.array_join(F.transform("p", lambda p: p["event_id"].cast("string")), ",").cast("binary")).alias("line"))


@query("scene_topk", """SELECT id, round(share, 6) AS share, cloud FROM (SELECT event_id AS id, ts, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 20 END AS cloud,
    greatest(0, least(32.9::DOUBLE + (event_id % 7)::DOUBLE * 0.01::DOUBLE, 32.82::DOUBLE) - greatest(32.60::DOUBLE + (event_id % 5)::DOUBLE * 0.01::DOUBLE, 32.62::DOUBLE)) * greatest(0, least((-27.30)::DOUBLE, (-27.32)::DOUBLE) - greatest((-27.64)::DOUBLE, (-27.62)::DOUBLE)) / (0.2::DOUBLE * 0.3::DOUBLE) AS share FROM events)
    WHERE share >= 0.94 AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' AND coalesce(cloud, 100) < 5 ORDER BY coalesce(cloud, 100), id LIMIT 12""", bare=True)
def scene_topk(spark, sf):
    catalogue = table(spark, sf, "events").select(
        F.col("event_id").alias("id"), "ts", F.when(F.col("event_id") % 11 != 0, F.col("value") / 20).alias("cloud"),
        (F.lit(32.60) + (F.col("event_id") % 5).cast("double") * 0.01).alias("lon_min"), F.lit(-27.64).alias("lat_min"), (F.lit(32.9) + (F.col("event_id") % 7).cast("double") * 0.01).alias("lon_max"), F.lit(-27.30).alias("lat_max"),
    )
    return files.select_scenes(catalogue, BOX, "2024-01-05", "2024-01-25", cover=0.94).select("id", R6("share"), "cloud")


@query("deglint_scale", "SELECT l_orderkey, l_linenumber, round(nullif(l_partkey % 5000, 0) * 0.0001::DOUBLE - nullif(l_suppkey % 50, 0) * 0.0001::DOUBLE, 9) AS b FROM lineitem", bare=True)
def deglint_scale(spark, sf):
    b = fuse.deglint(values.reflectance(F.col("l_partkey") % 5000), values.reflectance(F.col("l_suppkey") % 50))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(b, 9).alias("b"))


BANDS = "CASE WHEN l_discount > 0 THEN l_discount END AS b1, l_quantity / 100 AS b2, l_tax AS b3, l_extendedprice / 1e5 AS b4, l_tax AS b8"


def pixels(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("b1"), (F.col("l_quantity") / 100).alias("b2"), F.col("l_tax").alias("b3"), (F.col("l_extendedprice") / 1e5).alias("b4"), F.col("l_tax").alias("b8"), (-F.col("l_quantity")).alias("depth"), (F.col("l_suppkey") % 100).alias("track")
    )


@query("sdb_features", f"""SELECT l_orderkey, l_linenumber, round(ln_b1, 6) AS ln_b1, round(ln_b2, 6) AS ln_b2, round(ln_b3, 6) AS ln_b3, round(ln_b4, 6) AS ln_b4, round(ln_b2 / (ln_b3 + 1e-6), 6) AS ratio_b2_b3, round(ln_b2 / (ln_b4 + 1e-6), 6) AS ratio_b2_b4 FROM
    (SELECT *, CASE WHEN b1 IS NOT NULL THEN ln(greatest(b1, 1e-6)) END AS ln_b1, ln(greatest(b2, 1e-6)) AS ln_b2, ln(greatest(b3, 1e-6)) AS ln_b3, ln(greatest(b4, 1e-6)) AS ln_b4 FROM (SELECT l_orderkey, l_linenumber, {BANDS} FROM lineitem))""", bare=True)
def sdb_features(spark, sf):
    return model.features(pixels(spark, sf)).select("l_orderkey", "l_linenumber", *[R6(c) for c in model.FEATURES if c != "b8"])


@query("stumpf_regression", f"""SELECT round(regr_slope(-q, st), 6) AS slope, round(regr_intercept(-q, st), 6) AS intercept, count(*)::BIGINT AS n FROM
    (SELECT l_quantity AS q, ln(greatest(b2, 1e-6)) / (ln(greatest(b3, 1e-6)) + 1e-6) AS st FROM (SELECT l_quantity, {BANDS} FROM lineitem))""", bare=True)
def stumpf_regression(spark, sf):
    return model.baseline(model.features(pixels(spark, sf)), "stumpf", "depth").select(R6("slope"), R6("intercept"), "n")


@query("baseline_uncertainty", f"""WITH f AS (SELECT l_orderkey, l_linenumber, -l_quantity AS d, ln(greatest(b2, 1e-6)) / (ln(greatest(b3, 1e-6)) + 1e-6) AS st FROM (SELECT l_orderkey, l_linenumber, l_quantity, {BANDS} FROM lineitem)),
    r AS (SELECT regr_slope(d, st) AS a, regr_intercept(d, st) AS b FROM f) SELECT l_orderkey, l_linenumber, round(abs(d - (a * st + b)), 5) AS uncertainty FROM f, r""", bare=True)
def baseline_uncertainty(spark, sf):
    """How far a prediction (here the depth itself) lies from the linear baseline."""
    f = model.features(pixels(spark, sf))
    return model.with_baseline(f, model.baseline(f, "stumpf", "depth"), "stumpf").select("l_orderkey", "l_linenumber", F.round(F.abs(F.col("depth") - F.col("linear")), 5).alias("uncertainty"))


@query("tree_model_quality")
def tree_model_quality(spark, sf):
    """Boosted trees fitted on train tracks, against the mean, on held-out tracks; and the mean error of both."""
    f = model.split(model.features(pixels(spark, sf).where("b1 IS NOT NULL")))
    train, held = f.where("NOT holdout"), f.where("holdout")
    fitted = model.fit_trees(train, "depth", rounds=8, depth=4, step=0.3)
    scored = model.predict(fitted, held, ["l_orderkey", "l_linenumber"], floor=-100.0).crossJoin(F.broadcast(train.agg(F.avg("depth").alias("mean"))))
    rmse = lambda c: F.sqrt(F.avg(F.pow(F.col(c) - F.col("depth"), 2)))
    return scored.agg(F.count("predicted").alias("n"), F.round(rmse("predicted"), 4).alias("rmse"), F.round(rmse("mean"), 4).alias("rmse_of_mean"))


@query("point_sample", HELD + "SELECT event_id, y, x, z FROM held")
def point_sample(spark, sf):
    return sampled(spark, sf).select("event_id", "y", "x", "z")


@query("bilinear_resample", """AND , q AS (SELECT event_id AS id, (lat - (-27.62)::DOUBLE) / 0.01::DOUBLE - 0.5::DOUBLE AS fy, (lon - 32.62::DOUBLE) / 0.01::DOUBLE - 0.5::DOUBLE AS fx FROM s0),
    c AS (SELECT id, floor(fy)::BIGINT + dy AS y, floor(fx)::BIGINT + dx AS x, (CASE dy WHEN 0 THEN 1 - (fy - floor(fy)) ELSE fy - floor(fy) END) * (CASE dx WHEN 0 THEN 1 - (fx - floor(fx)) ELSE fx - floor(fx) END) AS w FROM q, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(dy, dx))
    SELECT id, round(v, 6) AS value FROM q LEFT JOIN (SELECT id, sum(w * z) / nullif(sum(w), 0) AS v FROM c JOIN g USING (y, x) GROUP BY id) USING (id)""")
def bilinear_resample(spark, sf):
    fy, fx = (F.col("lat") - F.lit(-27.62)) / F.lit(0.01) - F.lit(0.5), (F.col("lon") - F.lit(32.62)) / F.lit(0.01) - F.lit(0.5)
    targets = soundings(spark, sf).select(F.col("event_id").alias("id"), "lon", "lat")
    return raster.bilinear(targets, cells(spark, sf), fy, fx).select("id", R6("value"))


@query("nearest_resample", "SELECT fy AS y, fx AS x, z FROM (SELECT a.r AS fy, b.r AS fx FROM range(60) a(r), range(40) b(r)) LEFT JOIN g ON g.y = fy // 2 AND g.x = fx // 2")
def nearest_resample(spark, sf):
    """The coarse grid on one twice as fine."""
    fine = raster.dense(spark.createDataFrame([], "y long, x long"), 40, 60)
    ground = cells(spark, sf).select(F.col("y").alias("_y"), F.col("x").alias("_x"), "z")
    return fine.join(ground, (F.floor(F.col("y") / 2) == F.col("_y")) & (F.floor(F.col("x") / 2) == F.col("_x")), "left").select("y", "x", "z")


@query("band_metrics", "AND , p AS (SELECT s.depth_m, g.z FROM s JOIN g USING (y, x)) " + bands_sql(EDGES, "p"))
def band_metrics(spark, sf):
    s = soundings(spark, sf)
    return metrics.band_metrics(s.join(cells(spark, sf).select("y", "x", "z"), ["y", "x"]), EDGES, "z", "depth_m").select("lo", "hi", "n", R6("rmse"), R6("mae"), R6("bias"))


@query("gate_status", HELD + """, e AS (SELECT abs(depth_m) AS d, z - depth_m AS e FROM held), k AS (SELECT lo, hi, cap, count(e)::BIGINT AS n, sqrt(avg(e * e)) AS r FROM (VALUES (0.0::DOUBLE, 15.0::DOUBLE, 1.5::DOUBLE), (15.0::DOUBLE, 25.0::DOUBLE, 2.5::DOUBLE), (900.0::DOUBLE, 999.0::DOUBLE, 1.0::DOUBLE)) b(lo, hi, cap) LEFT JOIN e ON d >= lo AND d < hi AND e IS NOT NULL GROUP BY lo, hi, cap)
    SELECT lo, hi, cap, n, round(r, 6) AS rmse, CASE WHEN n = 0 THEN 'N/A' WHEN r <= cap THEN 'PASS' ELSE 'FAIL' END AS status FROM k""")
def gate_status(spark, sf):
    return metrics.gates(sampled(spark, sf), [(0, 15, 1.5), (15, 25, 2.5), (900, 999, 1.0)], "z", "depth_m").select("lo", "hi", "cap", "n", R6("rmse"), "status")


@query("signed_bias_bands", HELD + bands_sql((0, 15, 25, 9999), "held"))
def signed_bias_bands(spark, sf):
    return metrics.band_metrics(sampled(spark, sf), (0, 15, 25, 9999), "z", "depth_m").select("lo", "hi", "n", R6("rmse"), R6("mae"), R6("bias"))


@query("nearest_match", """AND , m AS (SELECT avg(lat) AS a FROM s0), q AS (SELECT tr.*, lon * 111320.0::DOUBLE * cos(radians(m.a)) AS px, lat * 111320.0::DOUBLE AS py FROM tr, m),
    k AS (SELECT a.event_id AS id, b.event_id AS source_id, b.depth_m AS payload, (a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py) AS d2 FROM q a JOIN q b ON a.holdout AND NOT b.holdout AND abs(a.px - b.px) <= 100 AND abs(a.py - b.py) <= 100)
    SELECT q.event_id AS id, j.source_id, j.payload, round(sqrt(j.d2), 3) AS distance FROM q LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(d2, 3), source_id) AS r FROM k WHERE d2 <= 10000) WHERE r = 1) j ON j.id = q.event_id WHERE q.holdout""")
def nearest_match(spark, sf):
    """Held-out points and the nearest train point within 100 m on a plane; distances are told apart to a thousandth."""
    points = tracked(spark, sf)
    mean = points.agg(F.avg("lat").alias("mean_lat"))
    x, y = geo.equirect_m(F.col("lon"), F.col("lat"), F.col("mean_lat"))
    placed = points.crossJoin(F.broadcast(mean)).withColumn("px", x).withColumn("py", y)
    held = placed.where("holdout").select(F.col("event_id").alias("id"), "px", "py")
    known = placed.where("NOT holdout").select(F.col("event_id").alias("source_id"), F.col("depth_m").alias("payload"), "px", "py")
    return metrics.nearest_match(held, known, 100.0).select("id", "source_id", "payload", F.round("distance", 3).alias("distance"))


@query("coverage_counts", "SELECT 600::BIGINT AS cells, 600 - count(z)::BIGINT AS nodata, count(CASE WHEN z > 0 THEN 1 END)::BIGINT AS positive, round(100.0::DOUBLE * count(z) / 600, 6) AS covered FROM g")
def coverage_counts(spark, sf):
    grid = raster.dense(cells(spark, sf).select("y", "x", "z"), GRID.width, GRID.height)
    return metrics.coverage(metrics.assert_under_water(grid)).select("cells", "nodata", "positive", R6("covered"))


FOCAL = "FROM g a JOIN g b ON abs(a.y - b.y) <= {h} AND abs(a.x - b.x) <= {h} GROUP BY a.y, a.x, a.z"


@query("focal_mean", "SELECT a.y, a.x, round(avg(b.z), 9) AS z_mean " + FOCAL.format(h=1))
def focal_mean(spark, sf):
    return raster.focal_mean(cells(spark, sf), 3).select("y", "x", F.round("z_mean", 9).alias("z_mean"))


@query("focal_mean_padded", "AND , d AS (SELECT a.r AS y, b.r AS x, coalesce(z, 0) AS z FROM range(30) a(r), range(20) b(r) LEFT JOIN g ON g.y = a.r AND g.x = b.r), o AS (SELECT i.r AS dy, j.r AS dx FROM range(-3, 4) i(r), range(-3, 4) j(r)) SELECT g.y, g.x, round(avg(d.z), 6) AS z_mean FROM g, o JOIN d ON d.y = least(29, greatest(0, g.y + o.dy)) AND d.x = least(19, greatest(0, g.x + o.dx)) GROUP BY g.y, g.x")
def focal_mean_padded(spark, sf):
    return raster.focal_mean_padded(cells(spark, sf), 7, GRID.width, GRID.height).select("y", "x", R6("z_mean"))


@query("rugosity", "SELECT a.y, a.x, round(sqrt(greatest(avg(b.z * b.z) - avg(b.z) * avg(b.z), 0)), 4) AS rugosity " + FOCAL.format(h=1))
def rugosity(spark, sf):
    return raster.rugosity(cells(spark, sf)).select("y", "x", F.round("rugosity", 4).alias("rugosity"))


@query("bpi", "SELECT a.y, a.x, round(a.z - avg(b.z), 9) AS bpi " + FOCAL.format(h=4))
def bpi(spark, sf):
    return raster.position_index(cells(spark, sf), 9).select("y", "x", F.round("bpi", 9).alias("bpi"))


@query("slope", """AND , d AS (SELECT a.*, CASE WHEN a.x = 0 THEN r.z - a.z WHEN a.x = 19 THEN a.z - l.z ELSE (r.z - l.z) / 2 END AS gx, CASE WHEN a.y = 0 THEN u.z - a.z WHEN a.y = 29 THEN a.z - d.z ELSE (u.z - d.z) / 2 END AS gy FROM g a
    LEFT JOIN g l ON l.y = a.y AND l.x = a.x - 1 LEFT JOIN g r ON r.y = a.y AND r.x = a.x + 1 LEFT JOIN g d ON d.x = a.x AND d.y = a.y - 1 LEFT JOIN g u ON u.x = a.x AND u.y = a.y + 1) SELECT y, x, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) AS slope FROM d""")
def slope(spark, sf):
    return raster.slope(cells(spark, sf), GRID.width, GRID.height).select("y", "x", R6("slope"))


@query("erosion", "SELECT a.y, a.x FROM g a JOIN g b ON abs(a.y - b.y) + abs(a.x - b.x) <= 2 GROUP BY a.y, a.x HAVING count(*) = 13")
def erosion(spark, sf):
    return raster.erode(cells(spark, sf), 2).select("y", "x")


DEEP = "z < (SELECT quantile_cont(z, 0.4) FROM g)"


@query("components", f"AND , n AS (SELECT y, x, y * 20 + x AS id FROM g WHERE {DEEP}), r(id, l) AS (SELECT id, id FROM n UNION SELECT b.id, r.l FROM r JOIN n a ON a.id = r.id JOIN n b ON abs(a.y - b.y) + abs(a.x - b.x) = 1) SELECT n.y, n.x, min(r.l) AS label FROM n JOIN r USING (id) GROUP BY n.y, n.x")
def components(spark, sf):
    """Cells below the 40th percentile, joined by sides."""
    ground = cells(spark, sf).select("y", "x", "z")
    deep = ground.crossJoin(F.broadcast(prospect.thresholds(ground, {"z": 0.4}))).where("z < t_z").select("y", "x")
    return raster.label_components(deep, GRID.width)


@query("nearest_fill", "AND , v AS (SELECT y, x, z FROM g WHERE (y + x) % 3 <> 0), k AS (SELECT t.y, t.x, v.z, (t.y - v.y) * (t.y - v.y) + (t.x - v.x) * (t.x - v.x) AS d2, v.y AS sy, v.x AS sx FROM (SELECT a.r AS y, b.r AS x FROM range(30) a(r), range(20) b(r)) t LEFT JOIN v ON abs(t.y - v.y) <= 3 AND abs(t.x - v.x) <= 3 AND (t.y - v.y) * (t.y - v.y) + (t.x - v.x) * (t.x - v.x) <= 9) SELECT y, x, arg_min(z, d2 * 1000000 + sy * 1000 + sx) AS filled, min(d2)::BIGINT AS d2 FROM k GROUP BY y, x")
def nearest_fill(spark, sf):
    known = cells(spark, sf).where((F.col("y") + F.col("x")) % 3 != 0).select("y", "x", "z")
    return raster.nearest_fill(known, raster.dense(spark.createDataFrame([], "y long, x long"), 20, 30), 3).select("y", "x", "filled", F.col("d2").cast("long").alias("d2"))


@query("overview_pyramid", "SELECT 2 AS factor, y // 2 AS y, x // 2 AS x, round(avg(z), 9) AS z, count(z)::BIGINT AS n FROM g GROUP BY ALL UNION ALL SELECT 4, y // 4, x // 4, round(avg(z), 9), count(z)::BIGINT FROM g GROUP BY ALL UNION ALL SELECT 8, y // 8, x // 8, round(avg(z), 9), count(z)::BIGINT FROM g GROUP BY ALL")
def overview_pyramid(spark, sf):
    return raster.pyramid(cells(spark, sf)).select("factor", "y", "x", F.round("z", 9).alias("z"), "n")


@query("category_pyramid", "AND , k AS (SELECT y // 4 AS y, x // 4 AS x, source, count(*) AS n FROM fused GROUP BY ALL) SELECT y, x, arg_min(source, -n * 100 + source)::INTEGER AS source FROM k GROUP BY y, x")
def category_pyramid(spark, sf):
    return raster.category_pyramid(fuse.priority_fuse(tiers(spark, sf)), 4, "source")


ROUGH = "AND , f AS (SELECT a.y, a.x, a.z, sqrt(greatest(avg(b.z * b.z) FILTER (abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1) - pow(avg(b.z) FILTER (abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1), 2), 0)) AS rugosity, a.z - avg(b.z) AS bpi FROM g a JOIN g b ON abs(a.y - b.y) <= 4 AND abs(a.x - b.x) <= 4 GROUP BY a.y, a.x, a.z), th AS (SELECT quantile_cont(rugosity, 0.5) AS tr, quantile_cont(bpi, 0.5) AS tb FROM f)"


def rough(spark, sf):
    ground = cells(spark, sf).select("y", "x", "z")
    return raster.rugosity(ground).join(raster.position_index(ground, 9).select("y", "x", "bpi"), ["y", "x"])


@query("percentile_thresholds", ROUGH + " SELECT round(tr, 4) AS t_rugosity, round(tb, 4) AS t_bpi, (SELECT count(*) FROM f WHERE rugosity > tr AND bpi > tb)::BIGINT AS candidates FROM th")
def percentile_thresholds(spark, sf):
    picked = prospect.candidate_cells(rough(spark, sf), 0.5, 0.5)
    return picked.groupBy(F.round("t_rugosity", 4).alias("t_rugosity"), F.round("t_bpi", 4).alias("t_bpi")).agg(F.count(F.lit(1)).alias("candidates"))


CLUSTERS = ROUGH + ", n AS (SELECT f.*, y * 20 + x AS id FROM f, th WHERE rugosity > tr AND bpi > tb), r(id, l) AS (SELECT id, id FROM n UNION SELECT b.id, r.l FROM r JOIN n a ON a.id = r.id JOIN n b ON abs(a.y - b.y) + abs(a.x - b.x) = 1), q AS (SELECT id, min(l) AS label FROM r GROUP BY id), c AS (SELECT label, count(*)::BIGINT AS area, avg(y) AS cy, avg(x) AS cx, avg(rugosity) AS rugosity, avg(bpi) AS bpi, avg(z) AS depth FROM n JOIN q USING (id) GROUP BY label HAVING count(*) >= 3)"


@query("cluster_stats", CLUSTERS + " SELECT label, area, round(cy, 6) AS cy, round(cx, 6) AS cx, round(rugosity, 4) AS rugosity, round(bpi, 4) AS bpi, round(depth, 4) AS depth FROM c")
def cluster_stats(spark, sf):
    found = prospect.clusters(prospect.candidate_cells(rough(spark, sf), 0.5, 0.5), GRID.width, 3)
    return found.select("label", "area", R6("cy"), R6("cx"), *[F.round(c, 4).alias(c) for c in ("rugosity", "bpi", "depth")])


SITES = "SELECT 32.62::DOUBLE + (c_custkey % 40)::DOUBLE * 0.005::DOUBLE AS lon, (-27.62)::DOUBLE + (c_custkey % 7)::DOUBLE * 0.04::DOUBLE AS lat FROM customer"
HAV = "12742.0::DOUBLE * asin(sqrt(least(1, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"


def known_sites(spark, sf):
    c = table(spark, sf, "customer")
    return c.select((F.lit(32.62) + (F.col("c_custkey") % 40).cast("double") * 0.005).alias("lon"), (F.lit(-27.62) + (F.col("c_custkey") % 7).cast("double") * 0.04).alias("lat"))


@query("nearest_site_km", f"SELECT s0.event_id AS id, round(min({HAV.format(a='s0', b='k')}), 6) AS km FROM s0, ({SITES}) k GROUP BY s0.event_id")
def nearest_site_km(spark, sf):
    return prospect.nearest_km(soundings(spark, sf).select(F.col("event_id").alias("id"), "lon", "lat"), known_sites(spark, sf)).select("id", R6("km"))


@query("prospect_rank", CLUSTERS + f", p AS (SELECT c.*, 32.62::DOUBLE + (cx + 0.5) * 0.01::DOUBLE AS lon, (-27.62)::DOUBLE + (cy + 0.5) * 0.01::DOUBLE AS lat FROM c), k AS (SELECT label, min({HAV.format(a='p', b='k')}) AS km FROM p, ({SITES}) k GROUP BY label), o AS (SELECT label, area, round(least(10, greatest(0, rugosity / (tr + 1e-6) * (bpi / (tb + 1e-6)))), 2) AS score, round(km, 4) AS km FROM p JOIN k USING (label), th WHERE km * 1000 >= 500) SELECT label, area, score, km, row_number() OVER (ORDER BY score DESC, label)::INTEGER AS rank FROM o QUALIFY rank <= 100")
def prospect_rank(spark, sf):
    found = prospect.leads(rough(spark, sf), GRID, known_sites(spark, sf), 0.5, 0.5, 3)
    return prospect.rank(found).select("label", "area", "score", F.round("km", 4).alias("km"), "rank")


POLYGONS = [(1, "Reef", [(32.63, -27.60), (32.70, -27.58), (32.68, -27.45), (32.64, -27.50), (32.63, -27.60)]), (2, "Sand", [(32.66, -27.55), (32.80, -27.55), (32.75, -27.35), (32.66, -27.55)]), (3, "Mud", [(32.62, -27.40), (32.65, -27.40), (32.65, -27.33), (32.62, -27.33), (32.62, -27.40)])]
EDGES_SQL = ", ".join(f"({pid}, '{name}', {ring[i][0]}::DOUBLE, {ring[i][1]}::DOUBLE, {ring[i + 1][0]}::DOUBLE, {ring[i + 1][1]}::DOUBLE)" for pid, name, ring in POLYGONS for i in range(len(ring) - 1))
INSIDE = f"e(pid, geology, x1, y1, x2, y2) AS (VALUES {EDGES_SQL}), h AS (SELECT s0.event_id, pid, geology FROM s0, e WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY s0.event_id, pid, geology HAVING count(*) % 2 = 1), sub AS (SELECT s0.event_id, s0.value, coalesce(k.geology, 'unknown') AS substrate FROM s0 LEFT JOIN (SELECT event_id, arg_min(geology, pid) AS geology FROM h GROUP BY event_id) k USING (event_id))"


def on_polygons(spark, sf):
    rows = spark.createDataFrame(POLYGONS, "pid int, geology string, ring array<struct<x:double,y:double>>")
    return prospect.in_polygons(soundings(spark, sf).withColumn("id", F.col("event_id")), rows)


@query("point_in_polygon", f"AND , {INSIDE} SELECT event_id, substrate FROM sub")
def point_in_polygon(spark, sf):
    return on_polygons(spark, sf).select("event_id", "substrate")


@query("substrate_corroborate", f"AND , {INSIDE} SELECT event_id, substrate, substrate IN ('Reef', 'Prominent Reef', 'Scattered Reef') AS corroborated, CASE substrate WHEN 'Reef' THEN 'corroborated' WHEN 'Sand' THEN 'weak' ELSE 'unverified' END AS confidence, CASE substrate WHEN 'Reef' THEN round((event_id % 1000) * 1.5, 2) WHEN 'Sand' THEN round((event_id % 1000) * 0.5, 2) ELSE (event_id % 1000)::DOUBLE END AS score FROM sub")
def substrate_corroborate(spark, sf):
    leads = on_polygons(spark, sf).withColumn("score", (F.col("event_id") % 1000).cast("double"))
    return prospect.corroborate(leads).select("event_id", "substrate", "corroborated", "confidence", "score")


@query("aoi_filter", "SELECT event_id, lon, lat FROM s0 WHERE lon BETWEEN 32.65::DOUBLE AND 32.75::DOUBLE AND lat BETWEEN (-27.55)::DOUBLE AND (-27.45)::DOUBLE")
def aoi_filter(spark, sf):
    return soundings(spark, sf).where(geo.in_box(F.col("lon"), F.col("lat"), (32.65, -27.55, 32.75, -27.45))).select("event_id", "lon", "lat")


@query("window_points", "SELECT y, x, round(32.62::DOUBLE + (x + 0.5) * 0.01::DOUBLE, 6) AS lon, round((-27.62)::DOUBLE + (y + 0.5) * 0.01::DOUBLE, 6) AS lat, z FROM g WHERE y BETWEEN 5 AND 12 AND x BETWEEN 3 AND 9")
def window_points(spark, sf):
    return files.raster_window(cells(spark, sf), GRID, (5, 12), (3, 9)).select("y", "x", R6("lon"), R6("lat"), "z")


@query("optical_mask", "SELECT y, x, CASE WHEN z <= 0 AND z >= -260 THEN z END AS z FROM g")
def optical_mask(spark, sf):
    return cells(spark, sf).select("y", "x", fuse.water_only(F.col("z"), -260.0).alias("z"))




@query("tile_count", "SELECT z::INTEGER AS zoom, ((trunc((32.82::DOUBLE + 180) / 360 * pow(2, z)) - trunc((32.62::DOUBLE + 180) / 360 * pow(2, z)) + 1) * (trunc((1 - asinh(tan(radians((-27.62)::DOUBLE))) / pi()) / 2 * pow(2, z)) - trunc((1 - asinh(tan(radians((-27.32)::DOUBLE))) / pi()) / 2 * pow(2, z)) + 1))::BIGINT AS tiles, tiles * 12000 AS bytes FROM range(8, 16) t(z)", bare=True)
def tile_count(spark, sf):
    return tiles.count(spark, BOX, 8, 15)


@query("tile_of_point", "SELECT event_id, trunc((lon + 180) / 360 * pow(2, 13))::INTEGER AS tx, trunc((1 - asinh(tan(radians(lat))) / pi()) / 2 * pow(2, 13))::INTEGER AS ty FROM s0")
def tile_of_point(spark, sf):
    x, y = geo.tile_xy(F.col("lon"), F.col("lat"), F.lit(13))
    return soundings(spark, sf).select("event_id", x.alias("tx"), y.alias("ty"))


@query("tile_bounds", "SELECT z::INTEGER AS zoom, tx, ty, round(tx * c / pow(2, z) - c / 2, 3) AS west, round(c / 2 - (ty + 1) * c / pow(2, z), 3) AS south, round((tx + 1) * c / pow(2, z) - c / 2, 3) AS east, round(c / 2 - ty * c / pow(2, z), 3) AS north FROM (SELECT z, tx::INTEGER AS tx, unnest(range(trunc((1 - asinh(tan(radians((-27.32)::DOUBLE))) / pi()) / 2 * pow(2, z))::BIGINT, trunc((1 - asinh(tan(radians((-27.62)::DOUBLE))) / pi()) / 2 * pow(2, z))::BIGINT + 1))::INTEGER AS ty, 2 * pi() * 6378137.0::DOUBLE AS c FROM (SELECT z, unnest(range(trunc((32.62::DOUBLE + 180) / 360 * pow(2, z))::BIGINT, trunc((32.82::DOUBLE + 180) / 360 * pow(2, z))::BIGINT + 1)) AS tx FROM range(8, 12) t(z)))", bare=True)
def tile_bounds(spark, sf):
    w, s, e, n = geo.tile_bounds(F.col("zoom"), F.col("tx"), F.col("ty"))
    return tiles.cover(spark, BOX, 8, 11).select("zoom", "tx", "ty", *[F.round(c, 3).alias(name) for c, name in ((w, "west"), (s, "south"), (e, "east"), (n, "north"))])


@query("tile_pixels")
def tile_pixels(spark, sf):
    """Heights of all pixels of the zoom-9 tiles as bytes."""
    return tiles.rendered(tiles.cover(spark, BOX, 9, 9), cells(spark, sf).select("y", "x", "z"), GRID, size=64).select("zoom", "tx", "ty", "px", "py", "r", "g", "b")


@query("terrarium_encode", "SELECT event_id, floor(v / 256)::INTEGER AS r, floor(v - floor(v / 256) * 256)::INTEGER AS g, floor((v - floor(v)) * 256)::INTEGER AS b FROM (SELECT event_id, greatest(0, least(65535.999, coalesce(CASE WHEN event_id % 13 <> 0 THEN depth_m END, 10) + 32768)) AS v FROM s0)")
def terrarium_encode(spark, sf):
    r, g, b = values.terrarium(F.when(F.col("event_id") % 13 != 0, F.col("depth_m")))
    return soundings(spark, sf).select("event_id", r.alias("r"), g.alias("g"), b.alias("b"))


@query("terrarium_rgba", "SELECT event_id, CASE WHEN v IS NULL THEN 128 ELSE floor(v / 256)::INTEGER END AS r, CASE WHEN v IS NULL THEN 0 ELSE floor(v % 256)::INTEGER END AS g, CASE WHEN v IS NULL THEN 0 ELSE floor((v - floor(v)) * 256)::INTEGER END AS b, CASE WHEN v IS NULL THEN 0 ELSE 255 END AS a FROM (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN greatest(0, least(65535.999, depth_m + 32768)) END AS v FROM s0)")
def terrarium_rgba(spark, sf):
    r, g, b, a = tiles.safe_terrarium(F.when(F.col("event_id") % 13 != 0, F.col("depth_m")))
    return soundings(spark, sf).select("event_id", r.alias("r"), g.alias("g"), b.alias("b"), a.alias("a"))


@query("mercator", "SELECT event_id, round(radians(lon) * 6378137.0::DOUBLE, 4) AS mx, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0::DOUBLE, 4) AS my FROM s0")
def mercator(spark, sf):
    x, y = geo.mercator(F.col("lon"), F.col("lat"))
    return soundings(spark, sf).select("event_id", F.round(x, 4).alias("mx"), F.round(y, 4).alias("my"))


@query("cell_keys", "SELECT event_id, y * 20 + x AS key, round(32.62::DOUBLE + (x + 0.5) * 0.01::DOUBLE, 6) AS lon, round((-27.62)::DOUBLE + (y + 0.5) * 0.01::DOUBLE, 6) AS lat FROM s")
def cell_keys(spark, sf):
    y, x = GRID.unkey(F.col("key"))
    keyed = soundings(spark, sf).withColumn("key", GRID.key(F.col("y"), F.col("x")))
    return keyed.select("event_id", "key", F.round(GRID.lon(x), 6).alias("lon"), F.round(GRID.lat(y), 6).alias("lat"))


@query("scattered_interpolation")
def scattered_interpolation(spark, sf):
    """Depth at cell centres, linear between the deepest sounding of each second cell; triangles within blocks of ten rows."""
    known = cells(spark, sf).where("(y + x) % 2 = 0").select(F.col("x").cast("double").alias("px"), F.col("y").cast("double").alias("py"), "z")
    from gridweave.operators.vector import interpolated

    targets = cells(spark, sf).select((F.col("y") * 20 + F.col("x")).alias("id"), F.col("x").cast("double").alias("px"), F.col("y").cast("double").alias("py"))
    return interpolated(known, targets, F.floor(F.col("py") / 10)).select("id", R6("value"))


@query("band_windows", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, CASE WHEN abs(depth_m) <= 15 THEN 'validated' WHEN abs(depth_m) <= 25 THEN 'optical-wall' ELSE 'coarse' END AS band, count(*)::BIGINT AS n, round(avg(depth_m), 6) AS mean_depth, min(depth_m) AS deepest FROM s0 GROUP BY ALL")
def band_windows(spark, sf):
    """Extra: bands per day, by the operator that also runs on streams."""
    from gridweave.streaming.bands import windowed_bands

    return windowed_bands(soundings(spark, sf)).select(F.date_format("start", "yyyy-MM-dd").alias("start"), "band", "n", R6("mean_depth"), "deepest")
