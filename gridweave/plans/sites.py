"""Registered queries on routes, catalogues and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridweave.functions import geo, values
from gridweave.operators import catalog, routes, vector
from gridweave.plans.relations import BOX, GRID, cells, query, soundings, table, waypoints

R6 = lambda c, name=None: F.round(c, 6).alias(name or c)

LEGS = """, lg AS (SELECT route, idx, lag(lon) OVER o AS lon0, lag(lat) OVER o AS lat0, lon AS lon1, lat AS lat1 FROM w WINDOW o AS (PARTITION BY route ORDER BY idx)),
lm AS (SELECT *, 12742000.0::DOUBLE * asin(sqrt(least(1, pow(sin(radians(lat1 - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(lat1)) * pow(sin(radians(lon1 - lon0) / 2), 2)))) AS metres,
    degrees(atan2(sin(radians(lon1 - lon0)) * cos(radians(lat1)), cos(radians(lat0)) * sin(radians(lat1)) - sin(radians(lat0)) * cos(radians(lat1)) * cos(radians(lon1 - lon0)))) AS deg FROM lg WHERE lon0 IS NOT NULL),
la AS (SELECT route, row_number() OVER o AS leg, lon0, lat0, lon1, lat1, metres, CASE WHEN deg < 0 THEN deg + 360 ELSE deg END AS bearing, sum(metres) OVER (PARTITION BY route ORDER BY idx ROWS UNBOUNDED PRECEDING) AS after FROM lm WINDOW o AS (PARTITION BY route ORDER BY idx))"""
#: Profiles over the tracks: every waypoint with the depth of its cell, where one of five has none.
PROFILE = """, pr AS (SELECT w.route, w.idx AS n, w.idx * 10.0::DOUBLE AS d, CASE WHEN (w.idx + w.route) % 5 <> 0 AND g.z > -2500 AND g.z < 5 THEN g.z END AS depth FROM w LEFT JOIN g ON g.y = floor((w.lat - (-27.62)::DOUBLE) / 0.01::DOUBLE)::BIGINT AND g.x = floor((w.lon - 32.62::DOUBLE) / 0.01::DOUBLE)::BIGINT),
pb AS (SELECT *, CASE WHEN abs(depth) <= 15 THEN 'validated' WHEN abs(depth) <= 25 THEN 'optical-wall' WHEN depth IS NOT NULL THEN 'coarse' END AS band FROM pr)"""


def profile(spark, sf):
    points = waypoints(spark, sf).select("route", F.col("idx").alias("n"), "lon", "lat", (F.col("idx") * 10).cast("double").alias("d"))
    deep = routes.with_depths(points, cells(spark, sf), GRID.row(F.col("lat")), GRID.col(F.col("lon")))
    known = F.when((F.col("n") + F.col("route")) % 5 != 0, F.col("depth"))
    return deep.withColumn("depth", known).withColumn("band", values.band(F.col("depth")))


@query("route_legs", "AND " + LEGS + " SELECT route, leg, round(metres, 4) AS metres, round(bearing, 6) AS bearing, round(after, 3) AS after FROM la")
def route_legs(spark, sf):
    return routes.legs(waypoints(spark, sf)).select("route", F.col("leg").cast("long").alias("leg"), F.round("metres", 4).alias("metres"), R6("bearing"), F.round("after", 3).alias("after"))


@query("route_samples", "AND " + LEGS + """, st AS (SELECT *, greatest(5000.0::DOUBLE, max(after) OVER (PARTITION BY route) / 400) AS step, max(after) OVER (PARTITION BY route) AS total, after - metres AS before FROM la),
    ks AS (SELECT *, unnest(generate_series(ceil((before + 1e-6) / step)::BIGINT, ceil((after - 1e-6) / step)::BIGINT - 1)) AS k FROM st WHERE metres > 0),
    al AS (SELECT route, 0.0::DOUBLE AS d FROM w WHERE idx = 0 UNION ALL SELECT route, k * step FROM ks WHERE k * step - before < metres - 1e-6 UNION ALL SELECT route, after FROM st WHERE total > 0)
    SELECT route, count(*)::BIGINT AS samples, round(max(d), 3) AS metres, round(avg(d), 3) AS mean_d FROM al GROUP BY route""")
def route_samples(spark, sf):
    s = routes.samples(waypoints(spark, sf), spacing=5000.0)
    return s.groupBy("route").agg(F.count(F.lit(1)).alias("samples"), F.round(F.max("d"), 3).alias("metres"), F.round(F.avg("d"), 3).alias("mean_d"))


@query("route_stats", "AND " + PROFILE + """ SELECT route, arg_min(depth, n) FILTER (n = 0) AS entry_depth, (SELECT q.depth FROM pb q WHERE q.route = pb.route ORDER BY n DESC LIMIT 1) AS exit_depth, min(depth) AS max_depth, (SELECT q.d FROM pb q WHERE q.route = pb.route AND depth IS NOT NULL ORDER BY depth, n LIMIT 1) AS max_at,
    round(avg(depth), 6) AS mean_depth, count(depth)::BIGINT AS valid, (count(*) - count(depth))::BIGINT AS invalid FROM pb GROUP BY route""")
def route_stats(spark, sf):
    return routes.summary(profile(spark, sf)).select("route", "entry_depth", "exit_depth", "max_depth", "max_at", R6("mean_depth"), "valid", "invalid")


@query("bands_crossed", "AND " + PROFILE + " SELECT route, string_agg(band, ',' ORDER BY n) AS bands FROM (SELECT route, band, min(n) AS n FROM pb WHERE band IS NOT NULL GROUP BY ALL) GROUP BY route")
def bands_crossed(spark, sf):
    return routes.bands_crossed(profile(spark, sf)).select("route", F.array_join("bands", ",").alias("bands"))


@query("depth_islands", "AND " + PROFILE + ", br AS (SELECT *, sum(CASE WHEN depth IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY route ORDER BY n ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM pb) SELECT route, run, min(n)::BIGINT AS first_n, max(n)::BIGINT AS last_n, count(*)::BIGINT AS samples, CASE max(CASE band WHEN 'coarse' THEN 3 WHEN 'optical-wall' THEN 2 ELSE 1 END) WHEN 3 THEN 'coarse' WHEN 2 THEN 'optical-wall' ELSE 'validated' END AS worst FROM br WHERE depth IS NOT NULL GROUP BY route, run")
def depth_islands(spark, sf):
    return routes.islands(profile(spark, sf)).select("route", "run", F.col("first_n").cast("long").alias("first_n"), F.col("last_n").cast("long").alias("last_n"), "samples", "worst")


@query("route_report_lines", "AND " + LEGS + " SELECT route, '  Leg ' || leg || ' -> ' || (leg + 1) || ': heading ' || lpad((floor(bearing + 0.5)::BIGINT % 360)::VARCHAR, 3, '0') || '°, distance ' || floor(metres + 0.5)::BIGINT || ' m' AS line FROM la")
def route_report_lines(spark, sf):
    """The leg lines of every route's report."""
    p = profile(spark, sf)
    text = routes.report(waypoints(spark, sf), routes.summary(p), routes.bands_crossed(p))
    return text.select("route", F.explode(F.split("report", "\n")).alias("line")).where("line LIKE '  Leg %'")


@query("route_svg")
def route_svg(spark, sf):
    return routes.svg(profile(spark, sf))


def editor_points(spark, sf):
    """Customers as editor points: nation as zone, a cluster for most, and edits from their balance."""
    c = table(spark, sf, "customer")
    points = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("suggested"), F.col("c_nationkey").alias("zone"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey") % 100).alias("cluster"))
    edits = c.where("c_acctbal < 3000").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") < 1000, F.concat(F.lit("New "), "c_name")).alias("name"), F.when(F.col("c_acctbal") < 0, F.lit(True)).alias("removed"))
    return catalog.overlay(points, edits)


EDITOR = "SELECT c_custkey AS id, CASE WHEN c_acctbal < 1000 THEN 'New ' || c_name ELSE c_name END AS name, c_nationkey AS zone, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 100 END AS cluster, c_acctbal < 1000 AS renamed, c_acctbal < 0 AS removed FROM customer"


@query("overlay_edits", f"SELECT id, name, zone, renamed, removed FROM ({EDITOR})", bare=True)
def overlay_edits(spark, sf):
    return editor_points(spark, sf).select("id", "name", "zone", "renamed", "removed")


@query("cluster_unresolved", f"SELECT cluster, count(*)::BIGINT AS members, count(CASE WHEN NOT removed THEN 1 END)::BIGINT AS active, count(CASE WHEN NOT removed THEN 1 END) >= 2 AS unresolved FROM ({EDITOR}) WHERE cluster IS NOT NULL GROUP BY cluster", bare=True)
def cluster_unresolved(spark, sf):
    return catalog.cluster_state(editor_points(spark, sf), "cluster")


@query("cluster_keep_one", f"SELECT id, cluster IS NOT NULL AND id <> min(id) OVER (PARTITION BY cluster) AS removed FROM ({EDITOR})", bare=True)
def cluster_keep_one(spark, sf):
    """All of a cluster but its first point are removed."""
    from pyspark.sql import Window

    first = editor_points(spark, sf).withColumn("first", F.min("id").over(Window.partitionBy("cluster")))
    return catalog.keep_one(first, "cluster", F.col("id") == F.col("first")).select("id", "removed")


@query("editor_stats", f"SELECT count(*)::BIGINT AS total, count(CASE WHEN NOT removed THEN 1 END)::BIGINT AS active, count(CASE WHEN renamed THEN 1 END)::BIGINT AS renamed, count(CASE WHEN removed THEN 1 END)::BIGINT AS removed, count(DISTINCT cluster)::BIGINT AS clusters FROM ({EDITOR})", bare=True)
def editor_stats(spark, sf):
    return catalog.editor_stats(editor_points(spark, sf), "cluster")


@query("zone_groups", f"SELECT zone, min(id) AS first_seen, count(*)::BIGINT AS points, row_number() OVER (ORDER BY min(id))::INTEGER AS place FROM ({EDITOR}) GROUP BY zone", bare=True)
def zone_groups(spark, sf):
    return catalog.groups_in_order(editor_points(spark, sf), "zone", "id")


@query("site_search", f"SELECT id, name FROM ({EDITOR}) WHERE contains(lower(name), 'new customer#00000')", bare=True)
def site_search(spark, sf):
    return catalog.search(editor_points(spark, sf), " New Customer#00000 ", ["name"]).select("id", "name")


@query("visible_sites", "SELECT c_nationkey AS collection, count(*)::BIGINT AS shown FROM customer WHERE NOT coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal < 5000 END, false) GROUP BY c_nationkey", bare=True)
def visible_sites(spark, sf):
    sites = table(spark, sf, "customer").withColumn("hidden", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") < 5000))
    return catalog.visible(sites, admin=False).groupBy(F.col("c_nationkey").alias("collection")).agg(F.count(F.lit(1)).alias("shown"))


@query("layer_gate", "SELECT c_custkey AS id, c_custkey % 5 = 0 OR coalesce(CASE c_mktsegment WHEN 'BUILDING' THEN false WHEN 'MACHINERY' THEN true WHEN 'FURNITURE' THEN false END, true) AS shown FROM customer", bare=True)
def layer_gate(spark, sf):
    config = F.create_map(F.lit("BUILDING"), F.lit(False), F.lit("MACHINERY"), F.lit(True), F.lit("FURNITURE"), F.lit(False))
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), catalog.layer_shown(config, F.col("c_mktsegment"), F.col("c_custkey") % 5 == 0).alias("shown"))


USER_ROWS = """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE ' site ' || event_id || ' ' END AS nm, CASE event_id % 5 WHEN 0 THEN 'abc' WHEN 1 THEN '99.5' ELSE '-27.' || (event_id % 900 + 100) || 'x' END AS la, '32.' || (event_id % 90 + 10) AS lo, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '-5000' ELSE '-' || (event_id % 40) || '.5m' END AS dp FROM events"""


@query("import_rows", f"""WITH u AS ({USER_ROWS}), n AS (SELECT *, try_cast(regexp_extract(la, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') AS DOUBLE) AS lat, try_cast(regexp_extract(lo, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') AS DOUBLE) AS lon, try_cast(nullif(regexp_extract(dp, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)'), '') AS DOUBLE) AS d FROM u),
    a AS (SELECT *, coalesce(lat BETWEEN -29.62::DOUBLE AND -25.32::DOUBLE AND lon BETWEEN 30.62::DOUBLE AND 34.82::DOUBLE, false) AS accepted FROM n)
    SELECT event_id, accepted, CASE WHEN accepted THEN CASE WHEN trim(nm) <> '' THEN trim(nm) ELSE 'Site ' || sum(accepted::INT) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) END END AS name, lat, lon, CASE WHEN d BETWEEN -1000 AND 100 THEN d END AS depth_max_m FROM a""", bare=True)
def import_rows(spark, sf):
    e = F.col("event_id")
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(e % 3 == 0, "").otherwise(F.concat(F.lit(" site "), e.cast("string"), F.lit(" "))).alias("Site Name!"),
        F.when(e % 5 == 0, "abc").when(e % 5 == 1, "99.5").otherwise(F.concat(F.lit("-27."), (e % 900 + 100).cast("string"), F.lit("x"))).alias(" Latitude"),
        F.concat(F.lit("32."), (e % 90 + 10).cast("string")).alias("LNG"),
        F.when(e % 4 == 0, "").when(e % 4 == 1, "-5000").otherwise(F.concat(F.lit("-"), (e % 40).cast("string"), F.lit(".5m"))).alias("Depth (m)"),
    )
    fields = catalog.match_headers(rows.columns) | {"depth_max_m": "Depth (m)"}
    return catalog.import_rows(rows, {k: f"`{v}`" for k, v in fields.items()}, "event_id", BOX).select("event_id", "accepted", "name", "lat", "lon", "depth_max_m")


@query("import_totals", "SELECT count(CASE WHEN event_id % 5 NOT IN (0, 1) THEN 1 END)::BIGINT AS accepted, count(CASE WHEN event_id % 5 IN (0, 1) THEN 1 END)::BIGINT AS skipped, count(*)::BIGINT AS total FROM events", bare=True)
def import_totals(spark, sf):
    return catalog.import_totals(import_rows(spark, sf))


@query("unique_names", "SELECT p_partkey AS id, CASE WHEN n = 1 THEN p_type ELSE p_type || ' (' || n || ')' END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS n FROM part)", bare=True)
def unique_names(spark, sf):
    return catalog.unique_names(table(spark, sf, "part"), "p_type", "p_partkey").select(F.col("p_partkey").alias("id"), "unique_name")


@query("csv_export", """SELECT doc_id, doc_id::VARCHAR || ',' || CASE WHEN regexp_matches(t, '[",\n]') THEN '"' || replace(t, '"', '""') || '"' ELSE t END || ',' || CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS line FROM (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN 'say "' || text || '"' ELSE text END AS t FROM documents)""", bare=True)
def csv_export(spark, sf):
    d = table(spark, sf, "documents")
    note = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('say "'), "text", F.lit('"'))).otherwise(F.col("text"))
    rows = d.select("doc_id", note.alias("note"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("source"))
    return catalog.csv_lines(rows, ["doc_id", "note", "source"]).select("doc_id", "line")


@query("gpx_rows", """AND , q AS (SELECT event_id, lon, lat, CASE WHEN event_id % 4 = 0 THEN 'about -' || (event_id % 30) || '.5 m & more' ELSE '' END AS dp, event_type AS zone, event_id % 6 = 0 AS renamed, event_id % 7 = 0 AS removed FROM s0)
    SELECT event_id, format('  <wpt lat="{:.6f}" lon="{:.6f}">', lat, lon) || CASE WHEN dp <> '' THEN chr(10) || '    <ele>' || (event_id % 30) || '.5</ele>' ELSE '' END || chr(10) || '    <name>P&lt;' || event_id || '&gt;</name>' || chr(10) || '    <desc>' || zone || CASE WHEN renamed THEN ' · orig: O' || event_id ELSE '' END || CASE WHEN dp <> '' THEN ' · ' || replace(dp, '&', '&amp;') ELSE '' END || '</desc>' || chr(10) || '    <sym>Waypoint</sym>' || chr(10) || '  </wpt>' AS wpt FROM q WHERE NOT removed""")
def gpx_rows(spark, sf):
    e = F.col("event_id")
    points = soundings(spark, sf).select(
        "event_id", "lon", "lat", F.concat(F.lit("P<"), e.cast("string"), F.lit(">")).alias("name"), F.concat(F.lit("O"), e.cast("string")).alias("orig_name"), F.col("event_type").alias("zone"), F.lit("").alias("remarks"),
        F.when(e % 4 == 0, F.concat(F.lit("about -"), (e % 30).cast("string"), F.lit(".5 m & more"))).otherwise("").alias("depth"), (e % 6 == 0).alias("renamed"), (e % 7 == 0).alias("removed"),
    )
    return catalog.gpx_waypoints(points).select("event_id", "wpt")


@query("dmm_format", "SELECT event_id, 'S' || floor(-lat)::INTEGER || '°' || format('{:.3f}', (-lat - floor(-lat)) * 60) || '''' AS lat_text, 'E' || floor(lon)::INTEGER || '°' || format('{:.3f}', (lon - floor(lon)) * 60) || '''' AS lon_text FROM s0")
def dmm_format(spark, sf):
    return soundings(spark, sf).select("event_id", values.minutes(F.col("lat"), "N", "S").alias("lat_text"), values.minutes(F.col("lon"), "E", "W").alias("lon_text"))


@query("label_dedup", "SELECT id, key, '−' || floor(abs(d) + 0.5)::BIGINT || ' m' AS label FROM (SELECT key, min(id) AS id, arg_min(d, id) AS d FROM (SELECT event_id AS id, depth_m AS d, floor(depth_m + 0.5)::BIGINT || '@' || format('{:.3f},{:.3f}', 32.0::DOUBLE + (event_id % 8)::DOUBLE / 4, (-27.0)::DOUBLE - (event_id % 4)::DOUBLE / 8) AS key FROM s0 WHERE event_id % 2 = 0) GROUP BY key) ORDER BY id LIMIT 60")
def label_dedup(spark, sf):
    mid = F.array(F.lit(32.0) + (F.col("event_id") % 8).cast("double") / 4, F.lit(-27.0) - (F.col("event_id") % 4).cast("double") / 8)
    contours = soundings(spark, sf).select(F.col("event_id").alias("id"), F.col("depth_m").alias("depth"), F.array(F.array(F.lit(0.0), F.lit(0.0)), mid, F.array(F.lit(1.0), F.lit(1.0))).alias("line"), (1 - F.col("event_id") % 2).alias("emphasis"))
    return catalog.label_points(contours, "depth", "line")


@query("token_scan", "SELECT doc_id, len(list_distinct(t))::BIGINT AS kinds, len(t)::BIGINT AS tokens FROM (SELECT doc_id, regexp_extract_all(text, 'th[a-z]{6,}') AS t FROM documents) WHERE len(t) > 0", bare=True)
def token_scan(spark, sf):
    """Strings with a given beginning, such as keys in page sources; here long words on th."""
    found = table(spark, sf, "documents").select("doc_id", F.regexp_extract_all("text", F.lit("th[a-z]{6,}"), 0).alias("t")).where(F.size("t") > 0)
    return found.select("doc_id", F.size(F.array_distinct("t")).cast("long").alias("kinds"), F.size("t").cast("long").alias("tokens"))


@query("sha_hash", "SELECT doc_id, sha256(text) AS digest FROM documents", bare=True)
def sha_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query("neighbour_nav", f"SELECT id, lag(id) OVER o AS previous, lead(id) OVER o AS next FROM ({EDITOR}) WINDOW o AS (PARTITION BY zone ORDER BY name, id)", bare=True)
def neighbour_nav(spark, sf):
    return catalog.neighbours(editor_points(spark, sf), "id", ["name", "id"], ["zone"]).select("id", "previous", "next")


@query("color_ramp", "SELECT event_id, round(CASE WHEN d <= -120 THEN 5 WHEN d <= -60 THEN 5 + (d + 120) / 60 * (31 - 5) WHEN d <= -30 THEN 31 + (d + 60) / 30 * (119 - 31) WHEN d <= -10 THEN 119 + (d + 30) / 20 * (229 - 119) WHEN d <= 0 THEN 229 + (d + 10) / 10 * (255 - 229) ELSE 255 END, 6) AS green FROM (SELECT event_id, depth_m AS d FROM s0)")
def color_ramp(spark, sf):
    stops = [(-120.0, 5.0), (-60.0, 31.0), (-30.0, 119.0), (-10.0, 229.0), (0.0, 255.0)]
    return soundings(spark, sf).select("event_id", F.round(values.ramp(F.col("depth_m"), stops), 6).alias("green"))


@query("densify", """AND , ls AS (SELECT route, idx, lag(lon) OVER o AS x0, lag(lat) OVER o AS y0, lon AS x1, lat AS y1 FROM w WINDOW o AS (PARTITION BY route ORDER BY idx)), ll AS (SELECT *, sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS len FROM ls WHERE x0 IS NOT NULL),
    t AS (SELECT route, sum(len) AS total, greatest(2, trunc(sum(len) / 0.01::DOUBLE)::INTEGER + 1) AS n FROM ll GROUP BY route) SELECT route AS id, (n + 1)::BIGINT AS points, round(total, 6) AS length FROM t WHERE total > 0""")
def densify(spark, sf):
    """Every track as a line: how many points it gets, and its length."""
    lines = waypoints(spark, sf).groupBy(F.col("route").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "lon", "lat"))), lambda p: F.array(p["lon"], p["lat"])).alias("line"))
    dense = vector.densify(lines, 0.01)
    length = lines.select("id", F.expr("aggregate(sequence(1, size(line) - 1), 0D, (s, i) -> s + hypot(line[i][0] - line[i - 1][0], line[i][1] - line[i - 1][1]))").alias("length"))
    counted = dense.groupBy("id").agg(F.count(F.lit(1)).alias("points"))
    return counted.join(length, "id").select("id", "points", R6("length"))


@query("depth_labels", "SELECT event_id, CASE WHEN v > -2500 AND v < 5 THEN '−' || format('{:.1f} m', abs(floor(least(v, 0) * 10 + 0.5) / 10)) ELSE '−' END AS label FROM (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN depth_m * 6 END AS v FROM s0)")
def depth_labels(spark, sf):
    return soundings(spark, sf).select("event_id", values.depth_label(F.when(F.col("event_id") % 9 != 0, F.col("depth_m") * 6)).alias("label"))


@query("html_escape", "SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) AS digest FROM pages", bare=True)
def html_escape(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(values.xml_escape(F.col("html"), "&#39;").cast("binary")).alias("digest"))


@query("flag_filter", "SELECT event_id FROM events WHERE event_id % 6 = 0", bare=True)
def flag_filter(spark, sf):
    flags = F.array(F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd"), F.when(F.col("event_id") % 6 == 0, "error").otherwise("ok"))
    return table(spark, sf, "events").where(F.array_contains(flags, "error")).select("event_id")


@query("mojibake_repair", "SELECT doc_id, CASE WHEN text IS NOT NULL THEN true END AS repaired FROM documents", bare=True)
def mojibake_repair(spark, sf):
    """Texts read in the wrong encoding, on purpose, and put right."""
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("t"))
    broken = d.withColumn("broken", F.decode(F.col("t").cast("binary"), "ISO-8859-1"))
    return broken.select("doc_id", (values.demojibake(F.col("broken")) == F.col("t")).alias("repaired"))


@query("geojson_features", "SELECT event_id, '{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || (event_id % 90) || '.5,' || (event_id % 45) || '.25]},\"properties\":{\"name\":\"' || event_type || '\"}}' AS feature FROM events", bare=True)
def geojson_features(spark, sf):
    lon, lat = (F.col("event_id") % 90).cast("double") + 0.5, (F.col("event_id") % 45).cast("double") + 0.25
    return table(spark, sf, "events").select("event_id", catalog.feature(lon, lat, F.struct(F.col("event_type").alias("name"))).alias("feature"))


@query("union_collections", "SELECT c_custkey AS id, c_name AS name, NULL AS collection FROM customer UNION ALL SELECT s_suppkey, s_name, 'user' FROM supplier", bare=True)
def union_collections(spark, sf):
    official = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    user = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("user").alias("collection"))
    return official.unionByName(user, allowMissingColumns=True)
