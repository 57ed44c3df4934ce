"""Site catalogues: ingest, imports by header alias, edit overlays, duplicate clusters, visibility, exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.functions.geo import in_box
from gridweave.functions.values import csv_field, demojibake, first_number, number, number_prefix, whole, xml_escape

#: Header names, cleaned, by the field that they give (fixed values).
ALIASES: dict[str, tuple[str, ...]] = {
    "name": ("name", "site", "sitename", "site_name", "title"),
    "lat": ("lat", "latitude", "y"),
    "lon": ("lon", "lng", "long", "longitude", "x"),
    "depth_min_m": ("depth_min_m", "depth_min", "mindepth", "min_depth", "min_depth_m"),
    "depth_max_m": ("depth_max_m", "depth_max", "maxdepth", "max_depth", "max_depth_m", "depth", "depth_m"),
    "description": ("description", "desc", "notes", "note"),
    "collection": ("collection", "folder", "group", "category"),
}


def match_headers(headers: Sequence[str]) -> dict[str, str]:
    """For each field the first header that is one of its names, once lower-cased and cleaned."""
    out: dict[str, str] = {}
    for header in headers:
        cleaned = "".join(c for c in (header or "").strip().lower() if c.isascii() and (c.isalnum() or c == "_"))
        for name, aliases in ALIASES.items():
            if cleaned in aliases:
                out.setdefault(name, header)
    return out


def checked_point(lat: Column, lon: Column, box: tuple[float, float, float, float], margin: float = 2.0) -> Column:
    """Whether a point is on the globe and in the box with a margin; null coordinates are not."""
    near = lon.between(box[0] - margin, box[2] + margin) & lat.between(box[1] - margin, box[3] + margin)
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180) & near, F.lit(False))


def checked_depth(text: Column) -> Column:
    """Depth from a text, null where it is empty, unreadable, or outside -1000 to 100."""
    value = number_prefix(text)
    return F.when(value.between(-1000, 100), value)


def import_rows(rows: DataFrame, fields: Mapping[str, str], order: str, box: tuple[float, float, float, float]) -> DataFrame:
    """User rows with ``accepted``, typed fields, and for accepted rows without a name ``Site N``, N being their number among the accepted.

    ``fields`` comes from ``match_headers``; numbers are read from the start of a text, as browsers do. Numbering runs over accepted rows of
    one file in its order, so files are imported one by one.
    """
    text = lambda f: F.col(fields[f]).cast("string") if f in fields else F.lit(None).cast("string")
    lat, lon = number_prefix(text("lat")), number_prefix(text("lon"))
    typed = rows.select(
        order,
        F.trim(F.coalesce(text("name"), F.lit(""))).alias("_name"),
        lat.alias("lat"),
        lon.alias("lon"),
        checked_depth(text("depth_min_m")).alias("depth_min_m"),
        checked_depth(text("depth_max_m")).alias("depth_max_m"),
        F.trim(F.coalesce(text("description"), F.lit(""))).alias("description"),
        F.trim(F.coalesce(text("collection"), F.lit(""))).alias("collection"),
    ).withColumn("accepted", checked_point(F.col("lat"), F.col("lon"), box))
    so_far = F.sum(F.col("accepted").cast("int")).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    numbered = typed.withColumn("name", F.when(F.col("accepted"), F.when(F.col("_name") != "", F.col("_name")).otherwise(F.concat(F.lit("Site "), so_far.cast("string")))))
    return numbered.select(order, "accepted", "name", "lat", "lon", "depth_min_m", "depth_max_m", "description", "collection")


def import_totals(imported: DataFrame) -> DataFrame:
    return imported.agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("skipped"), F.count(F.lit(1)).alias("total"))


#: Where sites from dive logs come from, as their descriptions say (fixed value).
LOG = "Garmin dive log"


def describe(name: Column, depth: Column, dives: Column) -> Column:
    """Sentence on a site; depth in whole metres."""
    deep = F.when(depth.isNull(), "depth n/a").otherwise(F.concat(F.lit("~"), F.format_string("%.0f", F.bround(depth, 0)), F.lit(" m max")))
    logged = F.when(F.coalesce(dives, F.lit("")) == "", "logged dive").otherwise(F.concat(dives, F.lit(" logged dive(s)")))
    return F.concat(name, F.lit(": "), deep, F.lit(", from "), logged, F.lit(f" ({LOG})."))


def dive_sites(rows: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Sites from rows of dive-log clusters, all columns text: in the box, depths negative and swapped, names repaired, north first."""
    lon, lat = number(F.col("centroid_lon")), number(F.col("centroid_lat"))
    name = demojibake(F.coalesce(F.nullif(F.trim("candidate_reef"), F.lit("")), F.lit("UNNAMED")))
    deep, shallow = number(F.col("max_depth_m")), number(F.col("min_depth_m"))
    return (
        rows.where(in_box(lon, lat, box))
        .select(
            F.round(lon, 6).alias("lon"),
            F.round(lat, 6).alias("lat"),
            name.alias("name"),
            (-deep).alias("depth_min_m"),
            (-shallow).alias("depth_max_m"),
            whole(F.col("n_dives")).alias("n_dives"),
            demojibake(F.trim(F.coalesce("alt_names", F.lit("")))).alias("alt_names"),
            (F.upper(name) != "UNNAMED").alias("verified"),
            describe(name, deep, F.col("n_dives")).alias("description"),
        )
        .orderBy(F.col("lat").desc())
    )


def overlay(points: DataFrame, edits: DataFrame, key: str = "id") -> DataFrame:
    """Points with their edits: ``name`` edited or suggested, ``renamed`` where it differs from the suggestion, ``removed``."""
    changed = edits.select(key, F.col("name").alias("_name"), F.col("removed").alias("_removed"))
    name = F.coalesce("_name", "suggested")
    return points.join(changed, key, "left").withColumns({"renamed": F.coalesce(name != F.col("suggested"), F.lit(False)), "removed": F.coalesce("_removed", F.lit(False)), "name": name}).drop("_name", "_removed")


def keep_one(points: DataFrame, cluster: str, keep: Column) -> DataFrame:
    """Edits that remove all of a cluster but the kept one; points without a cluster are left alone."""
    kept = F.max(F.when(keep, 1).otherwise(0)).over(Window.partitionBy(cluster))
    return points.withColumn("removed", F.when(F.col(cluster).isNotNull() & (kept == 1), ~keep).otherwise(F.lit(False)))


def cluster_state(points: DataFrame, cluster: str) -> DataFrame:
    """Per cluster its members, those still there, and whether two or more are."""
    active = F.count_if(~F.col("removed"))
    return points.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count(F.lit(1)).alias("members"), active.alias("active"), (active >= 2).alias("unresolved"))


def editor_stats(points: DataFrame, cluster: str) -> DataFrame:
    return points.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("removed")).alias("active"),
        F.count_if(F.col("renamed")).alias("renamed"),
        F.count_if(F.col("removed")).alias("removed"),
        F.count_distinct(cluster).alias("clusters"),
    )


def groups_in_order(points: DataFrame, zone: str, order: str) -> DataFrame:
    """Zones with their points' number, ranked by where each is first seen."""
    first = points.groupBy(zone).agg(F.min(order).alias("first_seen"), F.count(F.lit(1)).alias("points"))
    return first.withColumn("place", F.row_number().over(Window.orderBy("first_seen")))


def search(points: DataFrame, query: str, columns: Sequence[str]) -> DataFrame:
    """Points with the query, as plain text and in any case, in one of the columns."""
    needle = query.strip().lower()
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(needle)), F.lit(False))
    return points.where(hit)


def visible(points: DataFrame, admin: bool, hidden: str = "hidden") -> DataFrame:
    """Hidden points are for administrators."""
    return points if admin else points.where(~F.coalesce(F.col(hidden), F.lit(False)))


def layer_shown(config: Column, layer: Column, admin: Column) -> Column:
    """A layer is hidden only where the configuration says false and the reader is no administrator."""
    return admin | F.coalesce(F.try_element_at(config, layer), F.lit(True))


def unique_names(rows: DataFrame, name: str, order: str) -> DataFrame:
    """Later holders of a name get `` (2)``, `` (3)`` and so on."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return rows.withColumn("unique_name", F.when(n == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit(" ("), n.cast("string"), F.lit(")"))))


def neighbours(rows: DataFrame, key: str, order: Sequence[str], part: Sequence[str] = ()) -> DataFrame:
    """Keys before and after each row."""
    w = Window.partitionBy(*part).orderBy(*order)
    return rows.withColumn("previous", F.lag(key).over(w)).withColumn("next", F.lead(key).over(w))


def csv_lines(sites: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sites as lines of CSV."""
    return sites.withColumn("line", F.concat_ws(",", *[csv_field(F.col(c).cast("string")) for c in columns]))


def csv_text(lines: DataFrame, order: str, columns: Sequence[str]) -> DataFrame:
    """One row with a whole CSV file, lines ended as the standard has them. An export of chosen sites, so a small table."""
    body = lines.agg(F.array_sort(F.collect_list(F.struct(order, "line"))).alias("l"))
    return body.select(F.concat_ws("\r\n", F.lit(",".join(columns)), F.transform("l", lambda x: x["line"])).alias("text"))


def gpx_waypoints(points: DataFrame) -> DataFrame:
    """Waypoints in GPX for points that are not removed: ``wpt`` with height from the depth's first number, name, and a description of what is known."""
    depth = first_number(F.col("depth"))
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    parts = F.concat_ws(" · ", blank("zone"), F.when(F.col("renamed"), F.concat(F.lit("orig: "), F.coalesce("orig_name", F.lit("")))), blank("remarks"), blank("depth"))
    height = F.when(depth.isNotNull(), F.concat(F.lit("\n    <ele>"), F.format_string("%.1f", -depth), F.lit("</ele>"))).otherwise("")
    desc = F.when(parts != "", F.concat(F.lit("    <desc>"), xml_escape(parts), F.lit("</desc>\n"))).otherwise("")
    wpt = F.concat(F.format_string('  <wpt lat="%.6f" lon="%.6f">', "lat", "lon"), height, F.lit("\n    <name>"), xml_escape(F.col("name")), F.lit("</name>\n"), desc, F.lit("    <sym>Waypoint</sym>\n  </wpt>"))
    return points.where(~F.col("removed")).withColumn("wpt", wpt)


def gpx_text(waypoints: DataFrame, order: str, creator: str = "gridweave") -> DataFrame:
    """One row with a whole GPX 1.1 file."""
    body = waypoints.agg(F.array_sort(F.collect_list(F.struct(order, "wpt"))).alias("w"))
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<gpx version="1.1" creator="{creator}" xmlns="http://www.topografix.com/GPX/1/1">\n'
    return body.select(F.concat(F.lit(head), F.array_join(F.transform("w", lambda x: x["wpt"]), "\n"), F.lit("\n</gpx>\n")).alias("text"))


def feature(lon: Column, lat: Column, properties: Column) -> Column:
    """A GeoJSON point feature as JSON text."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), properties.alias("properties")), {"ignoreNullFields": "false"})


def feature_collection(features: DataFrame, column: str, order: str, name: str) -> DataFrame:
    """One row with a GeoJSON feature collection."""
    body = features.agg(F.array_sort(F.collect_list(F.struct(order, column))).alias("f"))
    return body.select(F.concat(F.lit(f'{{"type":"FeatureCollection","name":"{name}","features":['), F.array_join(F.transform("f", lambda x: x[column]), ","), F.lit("]}")).alias("text"))


def label_points(contours: DataFrame, depth: str, line: str, most: int = 60, order: str = "id") -> DataFrame:
    """Label places of emphasised contours, at the middle of each line: one per rounded depth and place, the first ``most``."""
    mid = F.element_at(F.col(line), F.floor(F.size(line) / 2).cast("int") + 1)
    keyed = contours.where((F.col("emphasis") == 1) & (F.size(line) > 0)).withColumn("_c", mid)
    key = F.concat_ws("@", F.floor(F.col(depth) + 0.5).cast("string"), F.format_string("%.3f,%.3f", F.col("_c")[0], F.col("_c")[1]))
    first = keyed.withColumn("key", key).groupBy("key").agg(F.min(F.struct(order, depth, "_c")).alias("m"))
    label = F.concat(F.lit("−"), F.floor(F.abs(F.col(f"m.{depth}")) + 0.5).cast("string"), F.lit(" m"))
    return first.select(F.col(f"m.{order}").alias(order), "key", label.alias("label")).orderBy(order).limit(most)


def import_features(documents: DataFrame, column: str, box: tuple[float, float, float, float], order: str = "n") -> DataFrame:
    """As ``import_rows``, from GeoJSON texts (one per row) that are a collection or a single feature; anything but points is skipped."""
    schema = "type string, geometry struct<type:string,coordinates:array<string>>, properties map<string,string>"
    whole = F.from_json(column, f"type string, features array<struct<{', '.join(p.replace(' ', ':', 1) for p in schema.split(', '))}>>")
    single = F.from_json(column, schema)
    features = F.when(whole["type"] == "FeatureCollection", whole["features"]).when(single["type"] == "Feature", F.array(single))
    rows = documents.select(F.posexplode(features).alias(order, "f"))
    point = (F.col("f.geometry.type") == "Point") & (F.size("f.geometry.coordinates") >= 2)
    text = lambda name: F.try_element_at(F.col("f.properties"), F.lit(name))
    place = lambda i: F.when(point, F.get(F.col("f.geometry.coordinates"), F.lit(i)))
    flat = rows.select(order, place(1).alias("lat"), place(0).alias("lon"), *[text(c).alias(c) for c in ("name", "depth_min_m", "depth_max_m", "description", "collection")])
    return import_rows(flat, {c: c for c in ALIASES}, order, box)


def apply_edits(sites: DataFrame, upserts: DataFrame, deletes: DataFrame, key: str = "id") -> DataFrame:
    """Sites with rows added or replaced and others deleted: a new table, as files are not changed in place."""
    kept = sites.join(upserts.select(key), key, "left_anti").unionByName(upserts, allowMissingColumns=True)
    return kept.join(deletes.select(key), key, "left_anti")


def selected(sites: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Sites that were picked for an export."""
    return sites.join(ids.select(key), key, "left_semi")
