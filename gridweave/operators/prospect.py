"""Leads: rough and raised cells, clustered, scored, and set against known sites and mapped substrate."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.functions.geo import EARTH_KM, Grid, haversine_km, in_ring
from gridweave.operators.raster import label_components
from gridweave.sources.scratch import written

#: Substrates that speak for a lead and against it (fixed values).
REEF = ("Reef", "Prominent Reef", "Scattered Reef")
SOFT = ("Sand", "Coarse Shelly Sediment")


def thresholds(cells: DataFrame, percentiles: dict[str, float], accuracy: int | None = None) -> DataFrame:
    """One row with a percentile of each column, exact with linear interpolation, or approximate where an accuracy is given."""
    take = (lambda c, p: F.percentile(c, p)) if accuracy is None else (lambda c, p: F.percentile_approx(c, p, accuracy))
    return cells.agg(*[take(F.col(c), p).alias(f"t_{c}") for c, p in percentiles.items()])


def candidate_cells(cells: DataFrame, rug: float = 0.92, bpi: float = 0.92) -> DataFrame:
    """Cells strictly above both percentiles, with the thresholds beside them (one row, broadcast)."""
    limits = thresholds(cells, {"rugosity": rug, "bpi": bpi})
    return cells.crossJoin(F.broadcast(limits)).where("rugosity > t_rugosity AND bpi > t_bpi")


def clusters(cells: DataFrame, width: int, least: int = 12) -> DataFrame:
    """Clusters of candidate cells joined by sides: size, centre, means, and ratio to the thresholds. Small ones are left out."""
    labelled = label_components(written(cells, "candidates"), width)
    return labelled.groupBy("label").agg(
        F.count(F.lit(1)).alias("area"),
        F.avg("y").alias("cy"),
        F.avg("x").alias("cx"),
        F.avg("rugosity").alias("rugosity"),
        F.avg("bpi").alias("bpi"),
        F.avg("z").alias("depth"),
        F.first("t_rugosity").alias("t_rugosity"),
        F.first("t_bpi").alias("t_bpi"),
    ).where(F.col("area") >= least)


def score(rug: Column, t_rug: Column, bpi: Column, t_bpi: Column) -> Column:
    """Product of both ratios to the thresholds, within 0 to 10."""
    return F.least(F.lit(10.0), F.greatest(F.lit(0.0), (rug / (t_rug + 1e-6)) * (bpi / (t_bpi + 1e-6))))


def nearest_km(points: DataFrame, sites: DataFrame, none: float = 999.0, most_sites: int = 1000) -> DataFrame:
    """Points (``id``, ``lon``, ``lat``) with the distance to the nearest site.

    What lacks a coordinate is half the globe away from everything, as in the SQL; ``none`` is for no sites.
    Sites in one place count once. Up to ``most_sites`` places are counted and then listed for each small square that holds points
    (``listed_km``). More of them meet the points in rings of growing buckets (``ringed_km``).
    """
    places = sites.select("lon", "lat").distinct()
    few = places.limit(most_sites + 1).count() <= most_sites
    return listed_km(points, places, none) if few else ringed_km(points, places)


def listed_km(points: DataFrame, places: DataFrame, none: float, cell: float = 0.01, most_held: int = 200_000) -> DataFrame:
    """Points with the distance to the nearest of a few ``places``, which every task holds.

    Each square of ``cell`` degrees that holds points lists the places that can be nearest to any of them: those no farther from its
    middle than the nearest one and the square's width from corner to corner. A point looks at its square's list only. Lists are
    broadcast up to ``most_held`` entries in all, and joined by square beyond.
    """
    across = math.radians(cell) * EARTH_KM * math.sqrt(2.0) + 0.001  # a metre more than rounding can add to a distance
    square = lambda c: F.floor(F.col(c) / cell)
    middle = lambda c: (F.col(c) + 0.5) * cell
    squares = points.select(square("lon").alias("_x"), square("lat").alias("_y")).distinct()
    met = squares.crossJoin(F.broadcast(places)).withColumn("_d", haversine_km(middle("_x"), middle("_y"), F.col("lon"), F.col("lat")))
    whole = met.groupBy("_x", "_y").agg(F.min("_d").alias("_m"), F.collect_list(F.struct("_d", "lon", "lat")).alias("_s"))
    lists = written(whole.select("_x", "_y", F.filter("_s", lambda s: s["_d"] <= F.col("_m") + across).alias("_s")), "lists")
    held = lists.agg(F.sum(F.size("_s"))).first()[0] or 0
    km = F.array_min(F.transform("_s", lambda s: haversine_km(F.col("lon"), F.col("lat"), s["lon"], s["lat"])))
    mine = square("lon").eqNullSafe(F.col("_x")) & square("lat").eqNullSafe(F.col("_y"))
    return points.join(F.broadcast(lists) if held <= most_held else lists, mine, "left").withColumn("km", F.coalesce(km, F.lit(none))).drop("_x", "_y", "_s")


def ringed_km(points: DataFrame, places: DataFrame) -> DataFrame:
    """Points with the distance to the nearest of any number of ``places``; a point leaves when a ring is closer than anything farther out could be.

    The places are joined by bucket and never broadcast: each is entered into nine buckets, which Spark's estimates leave out.
    What is found in a ring, and who is left, are tables in the shared folder.
    """
    places, left, found = written(places, "places"), points, None
    for size in (0.001, 0.01, 0.1, 1.0, 10.0, 400.0):
        turn = max(1, round(360 / size))  # columns of buckets around the globe, so that those on both sides of 180 degrees are neighbours
        column = lambda c, size=size: F.floor((F.col(c) + 180.0) / size)
        columns = F.array_distinct(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: F.pmod(column("_o") + d, F.lit(turn))))  # noqa: B023
        rows = F.sequence(F.floor(F.col("_a") / size) - 1, F.floor(F.col("_a") / size) + 1)
        spread = places.select(F.col("lon").alias("_o"), F.col("lat").alias("_a")).withColumn("_x", F.explode(columns)).withColumn("_y", F.explode(rows))
        met = left.withColumn("_x", F.pmod(column("lon"), F.lit(turn))).withColumn("_y", F.floor(F.col("lat") / size)).join(spread.hint("merge"), ["_x", "_y"])
        best = met.groupBy(*left.columns).agg(F.min(haversine_km(F.col("lon"), F.col("lat"), F.col("_o"), F.col("_a"))).alias("km"))
        safe = F.lit(size * 111.0) * F.greatest(F.cos(F.radians(F.abs("lat") + size)), F.lit(0.0)) if size < 100 else F.lit(float("inf"))
        done = written(best.where(F.col("km") <= safe), "nearest")
        found = done if found is None else found.unionByName(done)
        left = written(left.join(done.select("id"), "id", "left_anti"), "left")
        if left.isEmpty():
            break
    return found.unionByName(left.withColumn("km", haversine_km(F.lit(None), F.lit(None), F.lit(0.0), F.lit(0.0))))


def in_polygons(points: DataFrame, polygons: DataFrame, cell: float = 0.05, none: str = "unknown") -> DataFrame:
    """Points with the ``geology`` of the first polygon (smallest ``pid``) whose ring holds them.

    Polygons (``pid``, ``geology``, ``ring`` of x, y structs) are entered into square buckets that their boxes touch; points look only into their own.
    """
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    steps = lambda v: F.sequence(F.floor(F.array_min(v) / cell), F.floor(F.array_max(v) / cell))
    entered = polygons.withColumn("_bx", F.explode(steps(xs))).withColumn("_by", F.explode(steps(ys)))
    placed = points.withColumn("_bx", F.floor(F.col("lon") / cell)).withColumn("_by", F.floor(F.col("lat") / cell))
    hits = placed.join(entered, ["_bx", "_by"]).where(in_ring(F.col("lon"), F.col("lat"), F.col("ring")))
    first = hits.groupBy("id").agg(F.min_by("geology", "pid").alias("substrate"))
    return points.join(first, "id", "left").withColumn("substrate", F.coalesce("substrate", F.lit(none)))


def corroborate(leads: DataFrame) -> DataFrame:
    """Scores times 1.5 on mapped reef and times 0.5 on soft ground, to two decimals, with a word on the confidence."""
    reef, soft = F.col("substrate").isin(*REEF), F.col("substrate").isin(*SOFT)
    return leads.withColumns(
        {
            "corroborated": reef,
            "score": F.when(reef, F.round(F.col("score") * 1.5, 2)).when(soft, F.round(F.col("score") * 0.5, 2)).otherwise(F.col("score")),
            "confidence": F.when(reef, "corroborated").when(soft, "weak").otherwise("unverified"),
        }
    )


def rank(leads: DataFrame, most: int = 100) -> DataFrame:
    """The ``most`` best leads, ranked from 1; equal scores in order of their label."""
    best = leads.orderBy(F.col("score").desc(), "label").limit(most)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), "label")))


def leads(cells: DataFrame, grid: Grid, sites: DataFrame, rug: float = 0.92, bpi: float = 0.92, least: int = 12, apart_m: float = 500.0) -> DataFrame:
    """Clusters of candidate cells that are ``apart_m`` or more from known sites, with place and score to two decimals."""
    found = clusters(candidate_cells(cells, rug, bpi), grid.width, least)
    placed = found.withColumn("id", F.col("label")).withColumn("lon", grid.lon(F.col("cx"))).withColumn("lat", grid.lat(F.col("cy")))
    far = nearest_km(written(placed, "leads"), sites).where(F.col("km") * 1000 >= apart_m)
    return far.withColumn("score", F.round(score(F.col("rugosity"), F.col("t_rugosity"), F.col("bpi"), F.col("t_bpi")), 2))
