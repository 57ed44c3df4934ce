"""Registered queries on files: derived tables are written in the formats that sources come in, read back and compared with SQL on the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.operators import catalog, metrics, model, vector
from gridweave.plans.grids import BANDS, bands_sql, pixels
from gridweave.plans.relations import BOX, EDGES, GRID, cells, query, soundings, table
from gridweave.sources import files
from gridweave.sources.scratch import new_path

#: Rows of a derived document: bounded, so that no task gathers more, however large the table is.
ROWS = 1000


def key() -> Column:
    return F.col("c_custkey")


def documents(spark: SparkSession, sf: str, text: Column, before: str, between: str, after: str) -> DataFrame:
    """Customers as documents of ``ROWS`` texts each."""
    customers = table(spark, sf, "customer").select(F.floor(key() / ROWS).alias("part"), F.struct(key(), text.alias("t")).alias("s"))
    gathered = customers.groupBy("part").agg(F.array_sort(F.collect_list("s")).alias("l"))
    return gathered.select("part", F.concat(F.lit(before), F.array_join(F.transform("l", lambda x: x["t"]), between), F.lit(after)).alias("text"))


def as_files(docs: DataFrame, name: str) -> str:
    """One file per document, in the shared folder."""
    path = new_path(docs.sparkSession, name)
    docs.repartition("part").write.partitionBy("part").text(path)
    return path


def tail(digits: str) -> Column:
    return F.expr(f"cast({digits} as string)")


@query("survey_csv", """SELECT c_name || ', "big"' || chr(10) || 'bay' AS name, ('-27.' || (c_custkey % 900 + 100))::DOUBLE AS lat, ('32.' || (c_custkey % 90 + 10))::DOUBLE AS lon, ('-' || (c_custkey % 40) || '.5')::DOUBLE AS depth_m
    FROM customer WHERE c_custkey % 9 <> 0""", bare=True)
def survey_csv(spark, sf):
    """Points from CSV files with a header, comment lines, quotes and line ends inside fields, and rows without a place."""
    note = F.when(key() % 50 == 1, "# a note, not a row\n").otherwise("")
    name = F.concat(F.lit('"'), "c_name", F.lit(', ""big""\nbay"'))
    lat = F.when(key() % 9 == 0, "").otherwise(F.concat(F.lit("-27."), tail("c_custkey % 900 + 100")))
    line = F.concat(note, F.concat_ws(",", name, lat, F.concat(F.lit("32."), tail("c_custkey % 90 + 10")), F.concat(F.lit("-"), tail("c_custkey % 40"), F.lit(".5"))))
    path = as_files(documents(spark, sf, line, "name,lat,lon,depth_m\n", "\n", "\n"), "survey")
    return files.csv(spark, path, "name string, lat double, lon double, depth_m double", "#", ("lat", "lon", "depth_m")).select("name", "lat", "lon", "depth_m")


SITES = "SELECT 'Point' AS geometry, (c_custkey % 90)::DOUBLE + 0.5 AS lon, (c_custkey % 45)::DOUBLE + 0.25 AS lat, c_name || ' }{ \"x\"' AS name, c_custkey AS n_dives, c_custkey % 2 = 0 AS verified FROM customer"
PROPERTIES = "name string, n_dives long, verified boolean"


def site_feature() -> Column:
    properties = F.struct(F.concat("c_name", F.lit(' }{ "x"')).alias("name"), key().alias("n_dives"), (key() % 2 == 0).alias("verified"))
    return catalog.feature((key() % 90).cast("double") + 0.5, (key() % 45).cast("double") + 0.25, properties)


@query("geojson_read", SITES, bare=True)
def geojson_read(spark, sf):
    """Features of whole GeoJSON files."""
    path = as_files(documents(spark, sf, site_feature(), '{"type":"FeatureCollection","features":[', ",\n", "]}"), "sites")
    return files.geojson(spark, path, PROPERTIES)


@query("geojson_salvage", SITES, bare=True)
def geojson_salvage(spark, sf):
    """Features of GeoJSON files that end inside one more feature: all that are whole."""
    cut = ',\r\n{"type":"Feature","geometry":{"type":"Point","coordin'
    path = as_files(documents(spark, sf, site_feature(), '{"type":"FeatureCollection","features":[', ",\r\n", cut), "broken")
    return files.geojson_tolerant(spark, path, PROPERTIES)


@query("editor_read", "SELECT c_custkey::VARCHAR AS id, c_mktsegment AS zone, c_name AS suggested, CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey % 100)::VARCHAR END AS cluster, CASE WHEN c_custkey % 3 = 0 THEN 'far,deep' ELSE '' END AS flags FROM customer", bare=True)
def editor_read(spark, sf):
    """Raw points of the editor from JSON arrays."""
    point = F.struct(
        key().cast("string").alias("id"),
        F.col("c_mktsegment").alias("zone"),
        F.col("c_name").alias("suggestedName"),
        F.when(key() % 4 != 0, tail("c_custkey % 100")).alias("clusterId"),
        F.when(key() % 3 == 0, F.array(F.lit("far"), F.lit("deep"))).otherwise(F.array().cast("array<string>")).alias("flags"),
    )
    path = as_files(documents(spark, sf, F.to_json(point), "[", ",", "]"), "editor")
    return files.editor_points(spark, path).select("id", "zone", "suggested", "cluster", F.array_join("flags", ",").alias("flags"))


@query("backup_read", "SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 2 = 0 THEN 'New ' || c_name END AS name, c_custkey % 5 = 0 AS removed FROM customer", bare=True)
def backup_read(spark, sf):
    """Edits from backup documents."""
    edit = F.to_json(F.struct(F.when(key() % 2 == 0, F.concat(F.lit("New "), "c_name")).alias("name"), (key() % 5 == 0).alias("removed")))
    entry = F.concat(F.lit('"'), key().cast("string"), F.lit('":'), edit)
    return files.backup_edits(documents(spark, sf, entry, "{", ",", "}"), "text")


@query("first_file", "SELECT n_nationkey AS nation, n_name AS name FROM nation", bare=True)
def first_file(spark, sf):
    """Of two tables that match a pattern, the one that comes first by name."""
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name")).coalesce(1)
    path = new_path(spark, "drop-in")
    nations.limit(3).write.parquet(f"{path}/b.parquet")
    nations.write.parquet(f"{path}/a.parquet")
    return files.first_file(spark, f"{path}/*.parquet").select("nation", "name")


@query("dive_sites", """WITH r AS (SELECT c_custkey AS k, 32.7 + (c_custkey % 20)::DOUBLE * 0.01 + 0.0000001234 AS lon, CASE WHEN c_custkey % 13 <> 0 THEN -27.4 - (c_custkey % 30)::DOUBLE * 0.01 - 0.0000001234 END AS lat,
    CASE c_custkey % 5 WHEN 0 THEN 'UNNAMED' WHEN 1 THEN 'Unnamed' WHEN 2 THEN 'José ' || c_custkey ELSE 'Site ' || c_custkey END AS name, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 40 + 0.5::DOUBLE END AS deep, (c_custkey % 6 + 1)::DOUBLE AS shallow,
    CASE c_custkey % 4 WHEN 1 THEN '3.0' WHEN 2 THEN '12.7' WHEN 3 THEN '' END AS dives FROM customer)
    SELECT round(lon, 6) AS lon, round(lat, 6) AS lat, name, -deep AS depth_min_m, -shallow AS depth_max_m, CASE dives WHEN '3.0' THEN 3 WHEN '12.7' THEN 12 ELSE 0 END AS n_dives, CASE WHEN k % 2 = 0 THEN 'été, b' ELSE '' END AS alt_names, upper(name) <> 'UNNAMED' AS verified,
    name || ': ' || CASE WHEN deep IS NULL THEN 'depth n/a' ELSE '~' || round_even(deep, 0)::BIGINT || ' m max' END || ', from ' || CASE WHEN coalesce(dives, '') = '' THEN 'logged dive' ELSE dives || ' logged dive(s)' END || ' (Garmin dive log).' AS description
    FROM r WHERE lon BETWEEN 32.62 AND 32.82 AND lat BETWEEN -27.62 AND -27.32""", bare=True)
def dive_sites(spark, sf):
    """Sites from dive-log clusters, all columns text: numbers that may be none, names to be repaired, depths to be turned and swapped."""
    broken = F.decode(F.encode(F.lit("José "), "UTF-8"), "ISO-8859-1")
    rows = table(spark, sf, "customer").select(
        F.format_string("%.10f", F.lit(32.7) + (key() % 20).cast("double") * 0.01 + 0.0000001234).alias("centroid_lon"),
        F.when(key() % 13 == 0, "south").otherwise(F.format_string("%.10f", F.lit(-27.4) - (key() % 30).cast("double") * 0.01 - 0.0000001234)).alias("centroid_lat"),
        F.when(key() % 5 == 0, " ").when(key() % 5 == 1, " Unnamed ").when(key() % 5 == 2, F.concat(broken, key().cast("string"))).otherwise(F.concat(F.lit("Site "), key().cast("string"))).alias("candidate_reef"),
        F.when(key() % 7 == 0, "x").otherwise(F.concat(tail("c_custkey % 40"), F.lit(".5"))).alias("max_depth_m"),
        tail("c_custkey % 6 + 1").alias("min_depth_m"),
        F.when(key() % 4 == 1, "3.0").when(key() % 4 == 2, "12.7").when(key() % 4 == 3, "").alias("n_dives"),
        F.when(key() % 2 == 0, F.concat(F.lit(" "), F.decode(F.encode(F.lit("été, b"), "UTF-8"), "ISO-8859-1"))).alias("alt_names"),
    )
    return catalog.dive_sites(rows, BOX)


@query("feature_import", """WITH r AS (SELECT n_nationkey AS n, n_name, n_nationkey % 4 = 3 AS line, CASE WHEN n_nationkey % 5 = 4 THEN 50.0::DOUBLE ELSE format('{:.2f}', -27 - n_nationkey * 0.05::DOUBLE)::DOUBLE END AS "at" FROM nation),
    a AS (SELECT *, NOT line AND "at" BETWEEN -29.62 AND -25.32 AS accepted FROM r)
    SELECT n, accepted, CASE WHEN accepted THEN CASE WHEN n % 3 = 0 THEN 'Site ' || sum(accepted::INT) OVER (ORDER BY n ROWS UNBOUNDED PRECEDING) ELSE n_name END END AS name, CASE WHEN NOT line THEN "at" END AS lat, CASE WHEN NOT line THEN 32.7::DOUBLE END AS lon, CASE WHEN n % 2 = 0 THEN n + 0.5::DOUBLE END AS depth_max_m FROM a""", bare=True)
def feature_import(spark, sf):
    """The nations, 25 at every size, as one GeoJSON document, imported: lines and places far away are passed over, nameless points numbered."""
    n = F.col("n_nationkey")
    at = F.when(n % 5 == 4, "50.0").otherwise(F.format_string("%.2f", F.lit(-27) - n * 0.05))
    place = F.when(n % 4 == 3, F.lit('"type":"LineString","coordinates":[[32.7,-27.5],[32.8,-27.5]]')).otherwise(F.concat(F.lit('"type":"Point","coordinates":[32.7,'), at, F.lit("]")))
    name = F.when(n % 3 == 0, "").otherwise(F.col("n_name"))
    depth = F.when(n % 2 == 0, F.concat(F.lit(',"depth_max_m":'), n.cast("string"), F.lit(".5"))).otherwise("")
    feature = F.concat(F.lit('{"type":"Feature","geometry":{'), place, F.lit('},"properties":{"name":"'), name, F.lit('"'), depth, F.lit("}}"))
    rows = table(spark, sf, "nation").select(n, feature.alias("f"))
    document = catalog.feature_collection(rows, "f", "n_nationkey", "nations")
    return catalog.import_features(document, "text", BOX).select("n", "accepted", "name", "lat", "lon", "depth_max_m")


@query("clip_polygons", """WITH r AS (SELECT c_custkey AS id, (c_custkey % 50)::DOUBLE * 0.01 - 0.105 AS x, (c_custkey % 30)::DOUBLE * 0.01 - 0.105 AS y FROM customer)
    SELECT id, round(greatest(x, 0), 6) AS west, round(greatest(y, 0), 6) AS south, round(least(x + 0.1, 0.3), 6) AS east, round(least(y + 0.05, 0.15), 6) AS north FROM r WHERE x < 0.3 AND x + 0.1 > 0 AND y < 0.15 AND y + 0.05 > 0""", bare=True)
def clip_polygons(spark, sf):
    """Rectangles cut to a box; the bounds of what is left."""
    x, y = (key() % 50).cast("double") * 0.01 - 0.105, (key() % 30).cast("double") * 0.01 - 0.105
    corner = lambda dx, dy: F.array(x + dx, y + dy)
    ring = F.array(corner(0.0, 0.0), corner(0.1, 0.0), corner(0.1, 0.05), corner(0.0, 0.05), corner(0.0, 0.0))
    cut = vector.clip_polygons(table(spark, sf, "customer").select(key().alias("id"), ring.alias("ring")), (0.0, 0.0, 0.3, 0.15))
    xs, ys = F.transform("ring", lambda p: p[0]), F.transform("ring", lambda p: p[1])
    return cut.select("id", F.round(F.array_min(xs), 6).alias("west"), F.round(F.array_min(ys), 6).alias("south"), F.round(F.array_max(xs), 6).alias("east"), F.round(F.array_max(ys), 6).alias("north"))


@query("simplify_lines", "SELECT c_custkey AS id, (CASE WHEN h / 2 > 2e-5 THEN 4 WHEN h > 2e-5 THEN 3 ELSE 2 END)::BIGINT AS points FROM (SELECT c_custkey, (c_custkey % 7)::DOUBLE * 1e-5 + 5e-6 AS h FROM customer)", bare=True)
def simplify_lines(spark, sf):
    """Lines with two equal bends of some height: the first stays where that is above the tolerance, the second, half as far from what is left, above twice that."""
    bend = (key() % 7).cast("double") * 1e-5 + 5e-6
    at = lambda x, h: F.array(F.lit(float(x)), h)
    lines = table(spark, sf, "customer").select(key().alias("id"), F.array(at(0, F.lit(0.0)), at(1, bend), at(2, bend), at(3, F.lit(0.0))).alias("line"))
    return vector.simplify(lines, 2e-5).select("id", F.size("line").cast("long").alias("points"))


@query("grid_places", "SELECT event_id, coalesce(y + event_id % 50 - 10 BETWEEN 0 AND 29 AND x + event_id % 9 - 4 BETWEEN 0 AND 19, false) AS inside FROM s")
def grid_places(spark, sf):
    """Whether cells, moved by some rows and columns, still lie in the grid."""
    e = F.col("event_id")
    return soundings(spark, sf).select("event_id", GRID.holds(F.col("y") + e % 50 - 10, F.col("x") + e % 9 - 4).alias("inside"))


LIMITS = ((0.0, 15.0, 1.5), (15.0, 25.0, 2.5), (900.0, 999.0, 1.0))
SHOWN = "coalesce(format('{{:.2f}}', {0}), 'n/a')".format


@query("accuracy_report", f"""AND , p AS (SELECT s.depth_m, g.z FROM s JOIN g USING (y, x)), b AS ({bands_sql(EDGES, 'p')}),
    k AS (SELECT lo, hi, cap, count(e)::BIGINT AS n, sqrt(avg(e * e)) AS rmse FROM (VALUES {', '.join(f'({a}::DOUBLE, {z}::DOUBLE, {c}::DOUBLE)' for a, z, c in LIMITS)}) l(lo, hi, cap) LEFT JOIN (SELECT abs(depth_m) AS d, z - depth_m AS e FROM p) ON d >= lo AND d < hi GROUP BY lo, hi, cap)
    SELECT '# Accuracy report' || chr(10) || chr(10) || '| band | n | RMSE | MAE |' || chr(10) || '|-|-|-|-|' || chr(10) || (SELECT string_agg(format('| {{:.0f}}-{{:.0f}} m | {{}} | {{}} | {{}} |', lo, hi, n, {SHOWN('rmse')}, {SHOWN('mae')}), chr(10) ORDER BY lo) FROM b)
    || chr(10) || chr(10) || (SELECT string_agg(format('- {{:.0f}}-{{:.0f}} m: {{}} (RMSE {{}}, at most {{:.2f}})', lo, hi, CASE WHEN n = 0 THEN 'N/A' WHEN rmse <= cap THEN 'PASS' ELSE 'FAIL' END, {SHOWN('rmse')}, cap), chr(10) ORDER BY lo) FROM k) AS text""")
def accuracy_report(spark, sf):
    """The Markdown report on block medians against the soundings of their cells."""
    pairs = soundings(spark, sf).join(cells(spark, sf).select("y", "x", "z"), ["y", "x"])
    return metrics.report(metrics.band_metrics(pairs, EDGES, "z", "depth_m"), metrics.gates(pairs, LIMITS, "z", "depth_m"))


@query("model_summary", f"""WITH f AS (SELECT l_suppkey % 100 AS track, -l_quantity AS d, ln(greatest(b2, 1e-6)) / (ln(greatest(b3, 1e-6)) + 1e-6) AS st FROM (SELECT l_suppkey, l_quantity, {BANDS} FROM lineitem) WHERE b1 IS NOT NULL)
    SELECT count(*)::BIGINT AS n_train, count(DISTINCT track)::BIGINT AS n_tracks, round(regr_slope(d, st), 6) AS stumpf_coef, 'GBTRegressor(2)' AS model, '{",".join(model.FEATURES)}' AS features FROM f""", bare=True)
def model_summary(spark, sf):
    """What is told of a fit, here of two small trees."""
    train = model.features(pixels(spark, sf).where("b1 IS NOT NULL"))
    fitted = model.fit_trees(train, "depth", rounds=2, depth=2)
    about = model.summary(fitted, train, model.baseline(train, "stumpf", "depth"))
    return about.select("n_train", "n_tracks", F.round("stumpf_coef", 6).alias("stumpf_coef"), "model", F.array_join("features", ",").alias("features"))
