"""Neighbourhood operators on cell relations (``y``, ``x`` and value columns); nodata is a missing row or a null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridweave.operators.graph import connected_components
from gridweave.sources.scratch import written


def along_x() -> WindowSpec:
    """Cells of a row, in order."""
    return Window.partitionBy("y").orderBy("x")


def along_y() -> WindowSpec:
    """Cells of a column, in order."""
    return Window.partitionBy("x").orderBy("y")


def dense(cells: DataFrame, width: int, height: int) -> DataFrame:
    """All cells of a ``width`` by ``height`` raster; those that ``cells`` lacks have null values."""
    spark = cells.sparkSession
    every = spark.range(width * height).select(F.floor(F.col("id") / width).cast("long").alias("y"), (F.col("id") % width).alias("x"))
    return every.join(cells, ["y", "x"], "left")


def near_blocks(cells: DataFrame, reach: int, size: int = 64) -> DataFrame:
    """Cells of all blocks of ``size`` that hold a value or lie within ``reach`` of such a block; so sparse rasters stay sparse."""
    edge = max(size, reach)
    own = cells.select(F.floor(F.col("y") / edge).alias("by"), F.floor(F.col("x") / edge).alias("bx")).distinct()
    around = lambda c: F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1))
    blocks = own.select(around("by").alias("by"), "bx").distinct().select("by", around("bx").alias("bx")).distinct()
    inside = lambda c: F.explode(F.sequence(F.col(c) * edge, F.col(c) * edge + (edge - 1)))
    grid = blocks.select(inside("by").alias("y"), "bx").select("y", inside("bx").alias("x"))
    return grid.join(cells, ["y", "x"], "left")


def focal_mean(cells: DataFrame, k: int, values: Sequence[str] = ("z",), suffix: str = "_mean") -> DataFrame:
    """``cells`` with the mean of each value over the ``k`` by ``k`` square around a cell, nodata passed over.

    The square is separable: sums and counts run over a range of columns and then over a range of rows, two windows whatever ``k`` is.
    """
    h = k // 2
    across, down = along_x().rangeBetween(-h, h), along_y().rangeBetween(-h, h)
    grid = near_blocks(cells.withColumn("_here", F.lit(True)), h)
    sums = {f"_s_{v}": F.sum(v).over(across) for v in values} | {f"_n_{v}": F.count(v).over(across) for v in values}
    means = {v + suffix: F.sum(f"_s_{v}").over(down) / F.nullif(F.sum(f"_n_{v}").over(down), F.lit(0)) for v in values}
    return grid.withColumns(sums).withColumns(means).where("_here").drop("_here", *sums)


def focal_mean_padded(cells: DataFrame, k: int, width: int, height: int, values: Sequence[str] = ("z",), suffix: str = "_mean") -> DataFrame:
    """Mean over the square on a whole raster, with nodata as 0 and edges repeated outward: what box filters over filled arrays give."""
    h = k // 2
    grid = dense(cells.select("y", "x", *values), width, height).select("y", "x", *[F.coalesce(v, F.lit(0.0)).alias(v) for v in values])

    def box(value: str, along: WindowSpec, at: str, n: int) -> Column:
        whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        before = F.greatest(F.lit(0), F.lit(h) - F.col(at))
        after = F.greatest(F.lit(0), F.col(at) + h - (n - 1))
        return (F.sum(value).over(along.rangeBetween(-h, h)) + F.first(value).over(whole) * before + F.last(value).over(whole) * after) / k

    first = grid.select("y", "x", *[box(v, along_x(), "x", width).alias(v) for v in values])
    return cells.join(first.select("y", "x", *[box(v, along_y(), "y", height).alias(v + suffix) for v in values]), ["y", "x"])


def rugosity(cells: DataFrame, k: int = 3, z: str = "z") -> DataFrame:
    """``cells`` with ``rugosity``, the standard deviation of ``z`` over the square."""
    means = focal_mean(cells.withColumn("_z", F.col(z)).withColumn("_zz", F.col(z) * F.col(z)), k, ("_z", "_zz"))
    spread = F.sqrt(F.greatest(F.col("_zz_mean") - F.col("_z_mean") * F.col("_z_mean"), F.lit(0.0)))
    return means.withColumn("rugosity", spread).drop("_z", "_zz", "_z_mean", "_zz_mean")


def position_index(cells: DataFrame, k: int, z: str = "z") -> DataFrame:
    """``cells`` with ``bpi``: the value less its focal mean."""
    return focal_mean(cells.withColumn("_z", F.col(z)), k, ("_z",)).withColumn("bpi", F.col(z) - F.col("_z_mean")).drop("_z", "_z_mean")


def slope(cells: DataFrame, width: int, height: int, z: str = "z", cell_size: float = 1.0) -> DataFrame:
    """``cells`` with ``slope`` in degrees: central differences inside, one-sided at the raster's edges, null beside nodata."""

    def gradient(along: WindowSpec, at: str, n: int) -> Column:
        here = F.col(at)
        low = F.when(F.lag(at).over(along) == here - 1, F.lag(z).over(along))
        high = F.when(F.lead(at).over(along) == here + 1, F.lead(z).over(along))
        return F.when(here == 0, high - F.col(z)).when(here == n - 1, F.col(z) - low).otherwise((high - low) / 2)

    steep = F.sqrt(F.pow(gradient(along_x(), "x", width), 2) + F.pow(gradient(along_y(), "y", height), 2)) / cell_size
    return cells.withColumn("slope", F.degrees(F.atan(steep)))


def erode(cells: DataFrame, n: int) -> DataFrame:
    """Cells all of whose neighbours within ``n`` steps (up, down, left, right) are there.

    A cell's free run to both sides is found along its row; the steps up and down then look at the runs of its column. Two windows
    whatever ``n`` is.
    """
    before, after = along_x().rowsBetween(Window.unboundedPreceding, 0), along_x().rowsBetween(0, Window.unboundedFollowing)
    starts = F.when(F.coalesce(F.lag("x").over(along_x()) != F.col("x") - 1, F.lit(True)), F.col("x"))
    ends = F.when(F.coalesce(F.lead("x").over(along_x()) != F.col("x") + 1, F.lit(True)), F.col("x"))
    runs = cells.withColumn("_a", starts).withColumn("_b", ends)
    free = runs.withColumn("_free", F.least(F.col("x") - F.max("_a").over(before), F.min("_b").over(after) - F.col("x"))).drop("_a", "_b")
    ok = F.col("_free") >= n
    for step in range(1, n + 1):
        for look in (F.lag, F.lead):
            beside = look("y", step).over(along_y()) == F.col("y") + (step if look is F.lead else -step)
            ok = ok & F.coalesce(beside & (look("_free", step).over(along_y()) >= n - step), F.lit(False))
    return free.withColumn("_ok", ok).where("_ok").drop("_ok", "_free")


def label_components(cells: DataFrame, width: int) -> DataFrame:
    """``cells`` with ``label``: the smallest ``y * width + x`` of the cells joined to it by sides.

    Rows are first cut into runs, so the graph has a node for each run; runs in neighbouring rows are joined where they overlap,
    block by block of columns.
    """
    size = 256
    start = F.when(F.coalesce(F.lag("x").over(along_x()) != F.col("x") - 1, F.lit(True)), F.col("x"))
    tagged = written(cells.select("y", "x").withColumn("_s", start).withColumn("run", F.col("y") * width + F.max("_s").over(along_x().rowsBetween(Window.unboundedPreceding, 0))).drop("_s"), "runs")
    runs = tagged.groupBy("run", "y").agg(F.min("x").alias("a"), F.max("x").alias("b")).withColumn("block", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor(F.col("b") / size))))
    below = runs.select(F.col("run").alias("run2"), (F.col("y") - 1).alias("y"), F.col("a").alias("a2"), F.col("b").alias("b2"), "block")
    edges = runs.join(below, ["y", "block"]).where("a <= b2 AND a2 <= b").select(F.col("run").alias("a"), F.col("run2").alias("b"))
    found = connected_components(edges).select(F.col("node").alias("run"), "component")
    labels = tagged.join(found, "run", "left").select("y", "x", F.coalesce("component", "run").alias("label"))
    return cells.join(labels, ["y", "x"])


def nearest_fill(cells: DataFrame, targets: DataFrame, reach: int, z: str = "z") -> DataFrame:
    """``targets`` (``y``, ``x``) with the value of the nearest cell within ``reach``, by distance and then row and column; null beyond.

    Only cells at the border of the valid area can be nearest to one outside, so only they are spread over the disc.
    """
    beside = lambda along, at: F.coalesce((F.lag(at).over(along) == F.col(at) - 1) & (F.lead(at).over(along) == F.col(at) + 1), F.lit(False))
    valid = cells.where(F.col(z).isNotNull()).select("y", "x", F.col(z).alias("z"))
    border = valid.withColumn("_in", beside(along_x(), "x") & beside(along_y(), "y")).where(~F.col("_in"))
    disc = [(dy, dx) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1) if dy * dy + dx * dx <= reach * reach]
    spread = border.withColumn("o", F.explode(F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in disc])))
    offers = spread.select((F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), "z", (F.col("o.dy") * F.col("o.dy") + F.col("o.dx") * F.col("o.dx")).alias("d2"), F.col("y").alias("sy"), F.col("x").alias("sx"))
    best = offers.join(targets.select("y", "x"), ["y", "x"], "left_semi").groupBy("y", "x").agg(F.min_by("z", F.struct("d2", "sy", "sx")).alias("filled"), F.min("d2").alias("d2"))
    own = valid.select("y", "x", F.col("z").alias("_own"))
    return targets.join(best, ["y", "x"], "left").join(own, ["y", "x"], "left").withColumn("filled", F.coalesce("_own", "filled")).withColumn("d2", F.when(F.col("_own").isNotNull(), 0).otherwise(F.col("d2"))).drop("_own")


def sample(points: DataFrame, cells: DataFrame, y: Column, x: Column) -> DataFrame:
    """Each point with the values of the cell it lies in (null where there is none)."""
    placed = points.withColumn("y", y).withColumn("x", x)
    return placed.join(cells, ["y", "x"], "left")


def bilinear(targets: DataFrame, cells: DataFrame, fy: Column, fx: Column, z: str = "z") -> DataFrame:
    """``targets`` (with unique ``id``) and ``value``: ``z`` at the fractional row ``fy`` and column ``fx``, weighted over the four cells around.

    Weights are renewed over the cells that have a value; null where none has.
    """
    corners = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a in (0, 1) for b in (0, 1)])
    spread = targets.withColumn("_fy", fy).withColumn("_fx", fx).withColumn("_c", F.explode(corners))
    weight = lambda f, d: F.when(d == 0, F.lit(1.0) - (f - F.floor(f))).otherwise(f - F.floor(f))
    asked = spread.select("id", (F.floor("_fy") + F.col("_c.dy")).alias("y"), (F.floor("_fx") + F.col("_c.dx")).alias("x"), (weight(F.col("_fy"), F.col("_c.dy")) * weight(F.col("_fx"), F.col("_c.dx"))).alias("w"))
    got = asked.join(cells.select("y", "x", F.col(z).alias("_z")).where("_z IS NOT NULL"), ["y", "x"])
    value = got.groupBy("id").agg((F.sum(F.col("w") * F.col("_z")) / F.nullif(F.sum("w"), F.lit(0.0))).alias("value"))
    return targets.join(value, "id", "left")


def pyramid(cells: DataFrame, factors: Sequence[int] = (2, 4, 8), z: str = "z") -> DataFrame:
    """Means over squares of each factor: ``factor``, ``y``, ``x``, ``z``, ``n``. Larger squares are added up from smaller ones where factors divide."""
    last, by, out = cells.select("y", "x", F.col(z).alias("_s"), F.when(F.col(z).isNotNull(), 1).otherwise(0).alias("_n")), 1, None
    for factor in factors:
        if factor % by:
            last, by = cells.select("y", "x", F.col(z).alias("_s"), F.when(F.col(z).isNotNull(), 1).otherwise(0).alias("_n")), 1
        step = factor // by
        last = last.groupBy(F.floor(F.col("y") / step).alias("y"), F.floor(F.col("x") / step).alias("x")).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
        by = factor
        level = last.where("_n > 0").select(F.lit(factor).alias("factor"), "y", "x", (F.col("_s") / F.col("_n")).alias("z"), F.col("_n").alias("n"))
        out = level if out is None else out.unionByName(level)
    return out


def category_pyramid(cells: DataFrame, factor: int, category: str) -> DataFrame:
    """Most frequent category of each square, the smallest of equals: categories are not averaged."""
    counts = cells.where(F.col(category).isNotNull()).groupBy(F.floor(F.col("y") / factor).alias("y"), F.floor(F.col("x") / factor).alias("x"), category).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("y", "x").agg(F.min_by(category, F.struct(-F.col("n"), category)).alias(category))
