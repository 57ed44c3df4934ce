"""Map tiles: cover of a box, pixels, height encoding, PNG."""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions.geo import MERCATOR_M, Grid, tile_bounds, tile_xy
from gridweave.functions.values import terrarium
from gridweave.sources.workers import map_arrow


def cover(spark: SparkSession, box: tuple[float, float, float, float], low: int, high: int) -> DataFrame:
    """Tiles (``zoom``, ``tx``, ``ty``) that touch a box at each zoom."""
    zooms = spark.range(low, high + 1).select(F.col("id").cast("int").alias("zoom"))
    x0, y1 = tile_xy(F.lit(box[0]), F.lit(box[1]), F.col("zoom"))
    x1, y0 = tile_xy(F.lit(box[2]), F.lit(box[3]), F.col("zoom"))
    return zooms.select("zoom", y0.alias("y0"), y1.alias("y1"), F.explode(F.sequence(x0, x1)).alias("tx")).select("zoom", "tx", F.explode(F.sequence("y0", "y1")).alias("ty"))


def count(spark: SparkSession, box: tuple[float, float, float, float], low: int, high: int, bytes_each: int = 12_000) -> DataFrame:
    """Tiles per zoom and what they are likely to weigh."""
    zooms = spark.range(low, high + 1).select(F.col("id").cast("int").alias("zoom"))
    x0, y1 = tile_xy(F.lit(box[0]), F.lit(box[1]), F.col("zoom"))
    x1, y0 = tile_xy(F.lit(box[2]), F.lit(box[3]), F.col("zoom"))
    n = ((F.abs(x1 - x0) + 1) * (F.abs(y1 - y0) + 1)).cast("long")
    return zooms.select("zoom", n.alias("tiles"), (n * bytes_each).alias("bytes"))


def pixels(tiles: DataFrame, size: int = 256) -> DataFrame:
    """All pixels of tiles with the longitude and latitude of their centres."""
    west, south, east, north = tile_bounds(F.col("zoom"), F.col("tx"), F.col("ty"))
    spread = tiles.withColumn("py", F.explode(F.sequence(F.lit(0), F.lit(size - 1)))).withColumn("px", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    mx = west + (F.col("px") + 0.5) * (east - west) / size
    my = north - (F.col("py") + 0.5) * (north - south) / size
    return spread.withColumn("lon", F.degrees(mx / MERCATOR_M)).withColumn("lat", F.degrees(F.atan(F.exp(my / MERCATOR_M)) * 2 - math.pi / 2))


def rendered(tiles: DataFrame, cells: DataFrame, grid: Grid, size: int = 256, z: str = "z", alpha: bool = False) -> DataFrame:
    """Pixels of tiles with the height of the cell they lie in as ``r``, ``g``, ``b``; tiles without any height are left out."""
    placed = pixels(tiles, size).withColumn("y", grid.row(F.col("lat"))).withColumn("x", grid.col(F.col("lon")))
    hit = placed.join(cells.select("y", "x", F.col(z).alias("_z")), ["y", "x"], "left")
    some = hit.where("_z IS NOT NULL").select("zoom", "tx", "ty").distinct()
    r, g, b = safe_terrarium(F.col("_z"))[:3] if alpha else terrarium(F.col("_z"))
    out = hit.join(some, ["zoom", "tx", "ty"], "left_semi").withColumns({"r": r, "g": g, "b": b})
    return (out.withColumn("a", F.when(F.col("_z").isNull(), 0).otherwise(255)) if alpha else out).drop("y", "x", "_z")


def safe_terrarium(z: Column) -> tuple[Column, Column, Column, Column]:
    """Height encoding in which nodata is 0 m and transparent."""
    v = F.greatest(F.lit(0.0), F.least(F.lit(65535.999), z + 32768.0))
    pick = lambda c, empty: F.when(z.isNull(), empty).otherwise(c.cast("int"))
    return pick(F.floor(v / 256.0), 128), pick(F.floor(v % 256.0), 0), pick(F.floor((v - F.floor(v)) * 256.0), 0), F.when(z.isNull(), 0).otherwise(255)


def png(rows: list[bytes], width: int, channels: int) -> bytes:
    """A PNG file of 8-bit rows with 3 or 4 channels."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, len(rows), 8, {3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + r for r in rows))) + chunk(b"IEND", b"")


def images(rendered_pixels: DataFrame, size: int = 256) -> DataFrame:
    """One row per tile with its ``png``. A tile's pixels, a fixed number, are gathered and encoded together."""
    channels = ["r", "g", "b", "a"] if "a" in rendered_pixels.columns else ["r", "g", "b"]
    whole = rendered_pixels.groupBy("zoom", "tx", "ty").agg(F.array_sort(F.collect_list(F.struct("py", "px", *channels))).alias("p"))
    flat = whole.select("zoom", "tx", "ty", F.flatten(F.transform("p", lambda p: F.array(*[p[c] for c in channels]))).alias("v"))
    row = size * len(channels)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = []
            for values in batch.column(3):
                data = values.values.to_numpy(zero_copy_only=False).astype("u1").tobytes()
                files.append(png([data[i : i + row] for i in range(0, len(data), row)], size, len(channels)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(files, pa.binary())], names=["zoom", "tx", "ty", "png"])

    return map_arrow(flat, encode, "zoom int, tx int, ty int, png binary")


def write_tree(tiles: DataFrame, path: str) -> None:
    """Write tiles as Parquet parted by zoom; a tile server reads ``png`` by its place."""
    tiles.write.mode("overwrite").partitionBy("zoom").parquet(path)
