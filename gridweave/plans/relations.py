"""Relations that the registered queries derive from the shared tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridweave.functions.geo import Grid
from gridweave.operators.fuse import block_median

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BOX = (32.62, -27.62, 32.82, -27.32)
#: Coarse grid of the soundings, south up: 20 by 30 cells.
GRID = Grid(*BOX, 0.01, north_up=False)
EDGES = (0.0, 5.0, 10.0, 15.0, 20.0, 25.0, 30.0)

#: The same relations for DuckDB: soundings ``s`` with their cells, block medians ``g``, three tiers ``t0 t1 t2`` and ``fused``.
WITH = """
s0 AS (SELECT event_id, user_id AS track, ts, event_type, value, 32.62::DOUBLE + (event_id * 7919 % 2000)::DOUBLE * 0.0001::DOUBLE AS lon,
    (-27.62)::DOUBLE + (event_id * 104729 % 3000)::DOUBLE * 0.0001::DOUBLE AS lat, -abs(value) AS depth_m, (event_id % 100)::DOUBLE / 100.0::DOUBLE AS confidence FROM events),
s AS (SELECT *, floor((lat - (-27.62)::DOUBLE) / 0.01::DOUBLE)::BIGINT AS y, floor((lon - 32.62::DOUBLE) / 0.01::DOUBLE)::BIGINT AS x FROM s0),
g AS (SELECT y, x, median(depth_m) AS z, count(depth_m)::BIGINT AS n FROM s GROUP BY y, x),
hs AS (SELECT track, (((h0 * 7296 + h1) % 10000 * 7296 + h2) % 10000 * 7296 + h3) % 10000 / 10000.0::DOUBLE AS share FROM (
    SELECT track, ('0x' || substr(m, 1, 8))::BIGINT % 10000 AS h0, ('0x' || substr(m, 9, 8))::BIGINT % 10000 AS h1, ('0x' || substr(m, 17, 8))::BIGINT % 10000 AS h2, ('0x' || substr(m, 25, 8))::BIGINT % 10000 AS h3
    FROM (SELECT track, md5('42:' || track::VARCHAR) AS m FROM (SELECT DISTINCT user_id AS track FROM events)))),
tr AS (SELECT s.*, share < 0.3::DOUBLE AS holdout FROM s JOIN hs USING (track)),
t0 AS (SELECT y, x, median(depth_m) AS z FROM tr WHERE NOT holdout AND event_type = 'purchase' GROUP BY y, x),
t1 AS (SELECT y, x, median(depth_m) AS z FROM tr WHERE NOT holdout AND event_type = 'view' AND x < 15 GROUP BY y, x),
t2 AS (SELECT y, x, median(depth_m) AS z FROM tr WHERE NOT holdout GROUP BY y, x),
fused AS (SELECT y, x, coalesce(t0.z, t1.z, t2.z) AS z, CASE WHEN t0.z IS NOT NULL THEN 1 WHEN t1.z IS NOT NULL THEN 4 ELSE 7 END AS source
    FROM t0 FULL JOIN t1 USING (y, x) FULL JOIN t2 USING (y, x)),
w AS (SELECT track AS route, row_number() OVER (PARTITION BY track ORDER BY ts, event_id) - 1 AS idx, lon, lat FROM s0)
"""


def query(name: str, sql: str | None = None, bare: bool = False) -> Callable[[Query], Query]:
    """Register a query, and the statement it is compared with; the relations above go before it unless it is ``bare``."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql if bare else f"WITH RECURSIVE {WITH.strip()}{sql.strip()[4:] if sql.strip().startswith('AND ') else ' ' + sql.strip()}"
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def soundings(spark: SparkSession, sf: str) -> DataFrame:
    """Points from ``events``: place, depth, confidence, track, and the cell of the coarse grid."""
    step = lambda factor, n: F.pmod(F.col("event_id") * factor, F.lit(n)).cast("double") * F.lit(0.0001)
    rows = table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("track"),
        "ts",
        "event_type",
        "value",
        (F.lit(32.62) + step(7919, 2000)).alias("lon"),
        (F.lit(-27.62) + step(104729, 3000)).alias("lat"),
        (-F.abs("value")).alias("depth_m"),
        (F.pmod("event_id", F.lit(100)).cast("double") / F.lit(100.0)).alias("confidence"),
    )
    return rows.withColumn("y", GRID.row(F.col("lat"))).withColumn("x", GRID.col(F.col("lon")))


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Block medians of the soundings."""
    return block_median(soundings(spark, sf), F.col("y"), F.col("x"), "depth_m")


def waypoints(spark: SparkSession, sf: str) -> DataFrame:
    """Each track as a route, in order of time."""
    order = Window.partitionBy("route").orderBy("ts", "event_id")
    tracks = soundings(spark, sf).select(F.col("track").alias("route"), "ts", "event_id", "lon", "lat")
    return tracks.select("route", (F.row_number().over(order) - 1).alias("idx"), "lon", "lat")
