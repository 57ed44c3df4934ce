"""Extras on streams: band counts per time window, and live sums per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.functions.values import band


def windowed_bands(points: DataFrame, ts: str = "ts", depth: str = "depth_m", every: str = "1 day", late: str = "2 days") -> DataFrame:
    """Points, mean depth and deepest depth per band and window of time; works alike on a stream, whose late rows are waited for, and on a table."""
    marked = points.withWatermark(ts, late) if points.isStreaming else points
    sums = marked.withColumn("band", band(F.col(depth))).groupBy(F.window(ts, every), "band").agg(F.count(depth).alias("n"), F.avg(depth).alias("mean_depth"), F.min(depth).alias("deepest"))
    return sums.select(F.col("window.start").alias("start"), "band", "n", "mean_depth", "deepest")


def cell_sums(points: DataFrame, y: Column, x: Column, z: str) -> DataFrame:
    """Count, sum and extremes per cell, which later batches can be added to (a median cannot)."""
    return points.select(y.alias("y"), x.alias("x"), F.col(z).alias("_z")).groupBy("y", "x").agg(F.count("_z").alias("n"), F.sum("_z").alias("total"), F.min("_z").alias("low"), F.max("_z").alias("high"))
