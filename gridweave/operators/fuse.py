"""Gridding points and fusing rasters: block medians, composites, priority tiers, masks, provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _median(column: str, accuracy: int | None) -> Column:
    """Exact median, which holds a cell's distinct values, or one from a sketch of bounded size."""
    return F.median(column) if accuracy is None else F.percentile_approx(column, 0.5, accuracy)


def block_median(points: DataFrame, y: Column, x: Column, z: str, least: int = 1, accuracy: int | None = None) -> DataFrame:
    """Median of the points of each cell, and their number. Only cells with ``least`` or more points are kept.

    Points are pre-aggregated before they are shuffled. Where single cells may hold a large part of all points, an ``accuracy`` bounds
    what is kept of each; the result is then a value near the median.
    """
    cells = points.select(y.alias("y"), x.alias("x"), F.col(z).alias("_z")).groupBy("y", "x").agg(_median("_z", accuracy).alias("z"), F.count("_z").alias("n"))
    return cells.where(F.col("n") >= least)


def composite(scenes: DataFrame, keys: Sequence[str], bands: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Median of each band over the scenes of a cell, nodata passed over."""
    return scenes.groupBy(*keys).agg(*[_median(b, accuracy).alias(b) for b in bands])


def deglint(visible: Column, infrared: Column) -> Column:
    """Visible reflectance less the infrared one."""
    return visible - infrared


def priority_fuse(tiers: Sequence[tuple[int, DataFrame]], z: str = "z") -> DataFrame:
    """Each cell's value from the first tier that has one, and that tier's code (``source``).

    ``tiers`` are (code, cells) in order of priority. All tiers are united and grouped once, instead of one join after another.
    """
    parts = [cells.where(F.col(z).isNotNull()).select("y", "x", F.col(z).alias("z"), F.lit(rank).alias("_rank"), F.lit(code).alias("source")) for rank, (code, cells) in enumerate(tiers)]
    first = F.min(F.struct("_rank", "z", "source"))
    return reduce(DataFrame.unionByName, parts).groupBy("y", "x").agg(first.alias("_f")).select("y", "x", "_f.z", "_f.source")


def composition(cells: DataFrame, source: str = "source") -> DataFrame:
    """Cells of each source and their share in percent."""
    counts = cells.groupBy(source).agg(F.count(F.lit(1)).alias("cells"))
    total = counts.agg(F.sum("cells").alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select(source, "cells", (F.lit(100.0) * F.col("cells") / F.col("_all")).alias("percent"))


def uncertainty(cells: DataFrame, sigmas: Mapping[int, float], source: str = "source") -> DataFrame:
    """``cells`` with the standard error of their source; unknown sources have none."""
    table = F.create_map(*[F.lit(v) for pair in sigmas.items() for v in pair])
    return cells.withColumn("sigma", F.try_element_at(table, F.col(source)))


def mask_land(cells: DataFrame, infrared: DataFrame, threshold: float = 0.06) -> DataFrame:
    """Cells less those whose infrared reflectance is above the threshold."""
    return cells.join(infrared.where(F.col("nir") > threshold).select("y", "x"), ["y", "x"], "left_anti")


def override_in_band(cells: DataFrame, base: str, other: str, low: float, high: float) -> DataFrame:
    """``fused``: the other value where both are there and the base lies in the band, else the base."""
    take = F.col(base).between(low, high) & F.col(other).isNotNull()
    return cells.withColumn("fused", F.when(take, F.col(other)).otherwise(F.col(base))).withColumn("overridden", F.coalesce(take, F.lit(False)))


def datum_offset(both: DataFrame, a: str, b: str, low: float, high: float, least: int = 500) -> DataFrame:
    """One row: ``n`` cells with both values and the first in the band, and the median of ``a - b`` over them, 0 where there are under ``least``."""
    use = F.col(a).between(low, high) & F.col(b).isNotNull()
    shift = F.median(F.when(use, F.col(a) - F.col(b)))
    n = F.count_if(use)
    return both.agg(n.alias("n"), F.when(n >= least, shift).otherwise(F.lit(0.0)).alias("offset"))


def water_only(z: Column, floor: float | None = None) -> Column:
    """Depths above water, and below an optical floor if one is given, become nodata."""
    keep = z <= 0 if floor is None else (z <= 0) & (z >= floor)
    return F.when(keep, z)
