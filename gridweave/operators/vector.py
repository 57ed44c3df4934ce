"""Lines and polygons: clip to a box, simplify, densify; and linear interpolation between scattered points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.sources.workers import group_arrow, map_arrow

Box = tuple[float, float, float, float]


def _arrow(df: DataFrame, column: str, change) -> DataFrame:
    """``df`` with an ``array<array<double>>`` column changed by a function on arrays of points; empty results drop the row."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [change(np.array(v, float).reshape(-1, 2)) if v else None for v in batch.column(at).to_pylist()]
            keep = [i for i, v in enumerate(lines) if v is not None and len(v)]
            columns = [c.take(pa.array(keep, pa.int64())) for c in batch.columns]
            columns[at] = pa.array([lines[i].tolist() for i in keep], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(df, run, df.schema)


def clip_ring(ring: np.ndarray, box: Box) -> np.ndarray:
    """A closed ring cut to a box, side by side (Sutherland and Hodgman, 1974); no points where nothing is left."""
    points = ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring
    for axis, limit, sign in ((0, box[0], 1), (0, box[2], -1), (1, box[1], 1), (1, box[3], -1)):
        out = []
        for k in range(len(points)):
            a, b = points[k - 1], points[k]
            in_a, in_b = sign * (a[axis] - limit) >= 0, sign * (b[axis] - limit) >= 0
            if in_a != in_b:
                t = (limit - a[axis]) / (b[axis] - a[axis])
                out.append(a + t * (b - a))
            if in_b:
                out.append(b)
        points = np.array(out).reshape(-1, 2)
    return np.vstack([points, points[:1]]) if len(points) >= 3 else np.zeros((0, 2))


def clip_polygons(polygons: DataFrame, box: Box, ring: str = "ring") -> DataFrame:
    """Polygons whose boxes meet the box, cut to it; the boxes are compared first, in the engine."""
    xs, ys = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    near = (F.array_min(xs) <= box[2]) & (F.array_max(xs) >= box[0]) & (F.array_min(ys) <= box[3]) & (F.array_max(ys) >= box[1])
    return _arrow(polygons.where(near), ring, lambda r: clip_ring(r, box))


def simplify_line(line: np.ndarray, tolerance: float) -> np.ndarray:
    """Points of a line that lie farther than the tolerance from what the others draw (Douglas and Peucker, 1973); ends stay."""
    keep = np.zeros(len(line), bool)
    keep[[0, -1]] = True
    todo = [(0, len(line) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        span, inner = line[b] - line[a], line[a + 1 : b] - line[a]
        length = np.hypot(*span)
        far = np.abs(inner[:, 0] * span[1] - inner[:, 1] * span[0]) / length if length else np.hypot(inner[:, 0], inner[:, 1])
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return line[keep]


def simplify(lines: DataFrame, tolerance: float, line: str = "line") -> DataFrame:
    """Each line or ring simplified. Rings that fall under four points are left as they are."""
    return _arrow(lines, line, lambda v: s if len(s := simplify_line(v, tolerance)) >= min(4, len(v)) or (v[0] != v[-1]).any() else v)


def densify(lines: DataFrame, step: float, key: str = "id", line: str = "line") -> DataFrame:
    """``n + 1`` points at equal parts of each line's length, ``n`` being the length over the step, cut to a whole number, and one more, 2 at least."""
    points = lines.select(key, F.posexplode(line).alias("i", "p")).select(key, "i", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))
    order = Window.partitionBy(key).orderBy("i")
    ends = points.select(key, "i", F.lag("x").over(order).alias("x0"), F.lag("y").over(order).alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1")).where("x0 IS NOT NULL")
    long = ends.withColumn("len", F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))
    after = F.sum("len").over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = Window.partitionBy(key)
    placed = long.withColumn("after", after).withColumn("total", F.sum("len").over(whole)).withColumn("last", F.max("i").over(whole)).where("total > 0")
    n = F.greatest(F.lit(2), F.floor(F.col("total") / step).cast("int") + 1)
    spread = placed.withColumn("n", n).withColumn("before", F.col("after") - F.col("len"))
    first = F.ceil(F.col("before") / F.col("total") * F.col("n"))
    final = F.when(F.col("i") == F.col("last"), F.col("n").cast("long")).otherwise(F.ceil(F.col("after") / F.col("total") * F.col("n")) - 1)
    each = spread.withColumn("k", F.explode(F.when(first <= final, F.sequence(first, final)).otherwise(F.array().cast("array<bigint>"))))
    t = F.when(F.col("len") > 0, (F.col("k") * F.col("total") / F.col("n") - F.col("before")) / F.col("len")).otherwise(0.0)
    return each.select(key, "k", (F.col("x0") + t * (F.col("x1") - F.col("x0"))).alias("x"), (F.col("y0") + t * (F.col("y1") - F.col("y0"))).alias("y"))


def triangulate(points: np.ndarray) -> np.ndarray:
    """Delaunay triangles (rows of three indices) by inserting one point after another (Bowyer, 1981; Watson, 1981)."""
    centre, reach = points.mean(0), np.ptp(points, axis=0).max() * 20 + 1
    all_points = np.vstack([points, centre + [[-reach, -reach], [reach, -reach], [0, reach]]])
    n = len(points)
    triangles: dict[tuple[int, int, int], tuple[float, float, float]] = {}

    def add(a: int, b: int, c: int) -> None:
        (ax, ay), (bx, by), (cx, cy) = all_points[[a, b, c]] - centre
        d = 2 * (ax * (by - cy) + bx * (cy - ay) + cx * (ay - by))
        if d == 0:
            return
        a2, b2, c2 = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        ux, uy = (a2 * (by - cy) + b2 * (cy - ay) + c2 * (ay - by)) / d, (a2 * (cx - bx) + b2 * (ax - cx) + c2 * (bx - ax)) / d
        triangles[(a, b, c)] = (ux, uy, (ax - ux) ** 2 + (ay - uy) ** 2)

    add(n, n + 1, n + 2)
    for i in range(n):
        x, y = all_points[i] - centre
        bad = [t for t, (ux, uy, r) in triangles.items() if (x - ux) ** 2 + (y - uy) ** 2 < r * (1 - 1e-12)]
        edges: dict[frozenset, int] = {}
        for t in bad:
            del triangles[t]
            for a, b in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0])):
                edges[frozenset((a, b))] = edges.get(frozenset((a, b)), 0) + 1
        for edge, times in edges.items():
            if times == 1:
                add(*edge, i)
    return np.array([t for t in triangles if max(t) < n], int).reshape(-1, 3)


def interpolate(points: np.ndarray, values: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Values at targets, linear in the triangle that holds each; NaN outside the hull."""
    out = np.full(len(targets), np.nan)
    unique, first = np.unique(points, axis=0, return_index=True)
    if len(unique) < 3:
        return out
    values = values[first]
    for a, b, c in triangulate(unique):
        p, q, r = unique[a], unique[b], unique[c]
        d = (q[1] - r[1]) * (p[0] - r[0]) + (r[0] - q[0]) * (p[1] - r[1])
        if d == 0:
            continue
        u = ((q[1] - r[1]) * (targets[:, 0] - r[0]) + (r[0] - q[0]) * (targets[:, 1] - r[1])) / d
        v = ((r[1] - p[1]) * (targets[:, 0] - r[0]) + (p[0] - r[0]) * (targets[:, 1] - r[1])) / d
        inside = (u >= -1e-9) & (v >= -1e-9) & (u + v <= 1 + 1e-9)
        out[inside] = (u * values[a] + v * values[b] + (1 - u - v) * values[c])[inside]
    return out


def interpolated(points: DataFrame, targets: DataFrame, group: Column, most: int = 5000) -> DataFrame:
    """``targets`` (``id``, ``px``, ``py``) of each group with ``value``, interpolated between the group's points (``px``, ``py``, ``z``).

    Triangles are built within a group, such as a block of the grid with its rim, so a group is to hold no more than ``most`` points; more
    raise, as triangles over thinned points would be others.
    """

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows > most:
            raise ValueError(f"group {key} holds {left.num_rows} points; use smaller groups")
        xy = lambda t: np.column_stack([t.column("px").to_numpy(), t.column("py").to_numpy()])
        value = interpolate(xy(left), left.column("z").to_numpy(), xy(right)) if left.num_rows and right.num_rows else np.full(right.num_rows, np.nan)
        return pa.table({"id": right.column("id"), "value": pa.array(value, pa.float64(), from_pandas=True)})

    a = points.select(group.alias("_g"), "px", "py", "z").groupBy("_g")
    b = targets.select(group.alias("_g"), "id", "px", "py").groupBy("_g")
    return group_arrow(a.cogroup(b), run, "id bigint, value double", points.sparkSession)


def line_parts(features: DataFrame, kind: str = "kind") -> DataFrame:
    """Parts that are lines: a geometry collection left over from clipping may hold points and areas too."""
    return features.where(F.col(kind).isin("LineString", "MultiLineString"))
