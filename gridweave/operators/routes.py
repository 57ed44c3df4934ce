"""Routes: legs between waypoints, samples along them, depth profiles and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridweave.functions.geo import bearing, haversine_km
from gridweave.functions.values import band, heading, valid_depth


def along() -> WindowSpec:
    """Waypoints of a route, in order."""
    return Window.partitionBy("route").orderBy("idx")


def legs(waypoints: DataFrame) -> DataFrame:
    """Legs of routes (``route``, ``idx`` from 0, ``lon``, ``lat``): ``leg`` from 1, ends, ``metres``, ``bearing``, ``before`` and ``after`` (running metres)."""
    lon0, lat0 = F.lag("lon").over(along()), F.lag("lat").over(along())
    ends = waypoints.select("route", "idx", lon0.alias("lon0"), lat0.alias("lat0"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1")).where("lon0 IS NOT NULL")
    measured = ends.withColumn("metres", haversine_km(F.col("lon0"), F.col("lat0"), F.col("lon1"), F.col("lat1")) * 1000).withColumn("bearing", bearing(F.col("lon0"), F.col("lat0"), F.col("lon1"), F.col("lat1")))
    after = F.sum("metres").over(along().rowsBetween(Window.unboundedPreceding, 0))
    return measured.withColumn("leg", F.row_number().over(along())).withColumn("after", after).withColumn("before", F.col("after") - F.col("metres")).drop("idx")


def samples(waypoints: DataFrame, spacing: float = 12.0, most: int = 400) -> DataFrame:
    """Positions along routes: all waypoints, and points every ``max(spacing, length / most)`` metres counted from the start.

    ``n`` numbers the positions of a route from 0, ``d`` is the way to each in metres. Spacing goes on across waypoints.
    """
    all_legs = legs(waypoints)
    total = all_legs.groupBy("route").agg(F.sum("metres").alias("total"))
    stepped = all_legs.join(total, "route").withColumn("step", F.greatest(F.lit(float(spacing)), F.col("total") / most))
    first, last = F.ceil((F.col("before") + 1e-6) / F.col("step")), F.ceil((F.col("after") - 1e-6) / F.col("step")) - 1
    inner = stepped.where(F.col("metres") > 0).withColumn("_k", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    d = F.col("_k") * F.col("step")
    t = (d - F.col("before")) / F.col("metres")
    between = inner.where(d - F.col("before") < F.col("metres") - 1e-6).select(
        "route", (F.col("lon0") + (F.col("lon1") - F.col("lon0")) * t).alias("lon"), (F.col("lat0") + (F.col("lat1") - F.col("lat0")) * t).alias("lat"), d.alias("d"), "leg", F.lit(0).alias("_end")
    )
    starts = waypoints.withColumn("_r", F.row_number().over(along())).where("_r = 1").select("route", "lon", "lat", F.lit(0.0).alias("d"), F.lit(0).alias("leg"), F.lit(0).alias("_end"))
    ends = stepped.where(F.col("total") > 0).select("route", F.col("lon1").alias("lon"), F.col("lat1").alias("lat"), F.col("after").alias("d"), "leg", F.lit(1).alias("_end"))
    order = Window.partitionBy("route").orderBy("leg", "_end", "d")
    return starts.unionByName(between).unionByName(ends).withColumn("n", F.row_number().over(order) - 1).select("route", "n", "lon", "lat", "d")


def with_depths(positions: DataFrame, cells: DataFrame, y: Column, x: Column, z: str = "z") -> DataFrame:
    """Positions with the depth of their cell, null where it is missing or none, and its band."""
    hit = positions.withColumn("y", y).withColumn("x", x).join(cells.select("y", "x", F.col(z).alias("_z")), ["y", "x"], "left")
    return hit.withColumn("depth", F.when(valid_depth(F.col("_z")), F.col("_z"))).withColumn("band", band(F.col("depth"))).drop("_z", "y", "x")


def summary(profile: DataFrame) -> DataFrame:
    """One row per route: entry and exit, the first deepest sample, the mean, and how many samples have a depth."""
    one = F.struct("n", "depth", "band", "d")
    return profile.groupBy("route").agg(
        F.min_by("depth", "n").alias("entry_depth"),
        F.max_by("depth", "n").alias("exit_depth"),
        F.min(F.when(F.col("depth").isNotNull(), F.struct("depth", "n", "d", "band"))).alias("_deep"),
        F.avg("depth").alias("mean_depth"),
        F.count("depth").alias("valid"),
        F.count(one).alias("samples"),
        F.max("d").alias("metres"),
    ).select("route", "entry_depth", "exit_depth", F.col("_deep.depth").alias("max_depth"), F.col("_deep.d").alias("max_at"), F.col("_deep.band").alias("max_band"), "mean_depth", "valid", (F.col("samples") - F.col("valid")).alias("invalid"), "samples", "metres")


def bands_crossed(profile: DataFrame) -> DataFrame:
    """One row per route: its bands in the order in which they are first met."""
    first = profile.where("band IS NOT NULL").groupBy("route", "band").agg(F.min("n").alias("n"))
    return first.groupBy("route").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "band"))), lambda s: s["band"]).alias("bands"))


def islands(profile: DataFrame) -> DataFrame:
    """Unbroken runs of samples with a depth: ``run``, first and last sample, and the worst band in it."""
    order = Window.partitionBy("route").orderBy("n")
    breaks = F.sum(F.when(F.col("depth").isNull(), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rank = F.when(F.col("band") == "coarse", 3).when(F.col("band") == "optical-wall", 2).when(F.col("band") == "validated", 1)
    return profile.withColumn("run", breaks).where("depth IS NOT NULL").groupBy("route", "run").agg(F.min("n").alias("first_n"), F.max("n").alias("last_n"), F.count(F.lit(1)).alias("samples"), F.max_by("band", rank).alias("worst"))


def report(waypoints: DataFrame, stats: DataFrame, crossed: DataFrame, title: str = "Planned route") -> DataFrame:
    """One row per route with a plain text report: entry, waypoints, legs, length, depth summary, and a note on uncertain bands."""
    place = F.format_string("%.6f, %.6f", "lat", "lon")
    points = waypoints.groupBy("route").agg(F.array_sort(F.collect_list(F.struct("idx", place.alias("t")))).alias("_p"))
    lines = legs(waypoints).groupBy("route").agg(F.array_sort(F.collect_list(F.struct("leg", F.concat(F.lit("  Leg "), F.col("leg").cast("string"), F.lit(" -> "), (F.col("leg") + 1).cast("string"), F.lit(": heading "), heading(F.col("bearing")), F.lit(", distance "), F.floor(F.col("metres") + 0.5).cast("string"), F.lit(" m")).alias("t")))).alias("_l"))
    depth = lambda c: F.when(F.col(c).isNull(), "no data (land / outside coverage)").otherwise(F.format_string("%.1f m", c))
    rest = points.join(lines, "route", "left").join(stats, "route", "left").join(crossed, "route", "left")
    uncertain = F.coalesce(F.arrays_overlap("bands", F.array(F.lit("optical-wall"), F.lit("coarse"))), F.lit(False))
    text = F.concat_ws(
        "\n",
        F.lit(title),
        F.lit("=" * 30),
        F.lit(""),
        F.concat(F.lit("Entry point: "), F.col("_p")[0]["t"]),
        F.concat(F.lit("  depth: "), depth("entry_depth")),
        F.lit(""),
        F.lit("Waypoints:"),
        F.transform("_p", lambda p, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), p["t"])),
        F.lit(""),
        F.when(F.size("_l") > 0, F.lit("Legs:")),
        F.transform("_l", lambda leg: leg["t"]),
        F.when(F.size("_l") > 0, F.lit("")),
        F.concat(F.lit("Total distance: "), F.floor(F.coalesce("metres", F.lit(0.0)) + 0.5).cast("string"), F.lit(" m ("), F.format_string("%.2f", F.coalesce("metres", F.lit(0.0)) / 1000), F.lit(" km)")),
        F.lit(""),
        F.lit("Depth summary:"),
        F.concat(F.lit("  Entry:   "), depth("entry_depth")),
        F.concat(F.lit("  Deepest: "), depth("max_depth"), F.when(F.col("max_depth").isNotNull(), F.concat(F.lit(" (at "), F.floor(F.col("max_at") + 0.5).cast("string"), F.lit(" m along route)"))).otherwise("")),
        F.concat(F.lit("  Average: "), depth("mean_depth")),
        F.concat(F.lit("  Exit:    "), depth("exit_depth")),
        F.concat(F.lit("  ("), F.coalesce("valid", F.lit(0)).cast("string"), F.lit("/"), F.coalesce("samples", F.lit(0)).cast("string"), F.lit(" samples had depth data)")),
        F.when(uncertain, F.lit("\nNote: this route crosses into lower-confidence depth bands; treat depths beyond 15 m as indicative, not precise.")),
    )
    return rest.select("route", text.alias("report"))


def svg(profile: DataFrame, width: int = 640, height: int = 160) -> DataFrame:
    """One row per route with an SVG depth profile: one polyline for each unbroken run, coloured by its worst band."""
    scale = profile.groupBy("route").agg(F.max("d").alias("_w"), F.min("depth").alias("_deep"))
    order = Window.partitionBy("route").orderBy("n")
    runs = profile.withColumn("run", F.sum(F.when(F.col("depth").isNull(), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))).where("depth IS NOT NULL").join(scale, "route")
    px = F.format_string("%.1f,%.1f", F.col("d") / F.nullif(F.col("_w"), F.lit(0.0)) * width, F.col("depth") / F.nullif(F.col("_deep"), F.lit(0.0)) * height)
    lines = runs.groupBy("route", "run").agg(F.array_sort(F.collect_list(F.struct("n", F.coalesce(px, F.lit("0.0,0.0")).alias("p")))).alias("_p")).join(islands(profile).select("route", "run", "worst"), ["route", "run"])
    colour = F.when(F.col("worst") == "coarse", "#c0392b").when(F.col("worst") == "optical-wall", "#e67e22").otherwise("#2e86c1")
    line = F.concat(F.lit('<polyline fill="none" stroke="'), colour, F.lit('" points="'), F.array_join(F.transform("_p", lambda p: p["p"]), " "), F.lit('"/>'))
    body = lines.groupBy("route").agg(F.array_sort(F.collect_list(F.struct("run", line.alias("s")))).alias("_s"))
    return body.select("route", F.concat(F.lit(f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {width} {height}">'), F.array_join(F.transform("_s", lambda s: s["s"]), ""), F.lit("</svg>")).alias("svg"))


def measure(waypoints: DataFrame) -> DataFrame:
    """One row per route: its length in metres and the bearing of its last leg."""
    return legs(waypoints).groupBy("route").agg(F.sum("metres").alias("metres"), F.max_by("bearing", "leg").alias("bearing"))
