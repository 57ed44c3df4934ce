"""Column expressions over coordinates: grids, distances, bearings, tiles, projections, rings."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
MERCATOR_M = 6378137.0
DEGREE_M = 111320.0
_X = F.lit


@dataclass(frozen=True)
class Grid:
    """A raster's place: bounds, cell size in degrees, and whether row 0 is the northern one."""

    lon_min: float
    lat_min: float
    lon_max: float
    lat_max: float
    res: float
    north_up: bool = True

    @property
    def width(self) -> int:
        return round((self.lon_max - self.lon_min) / self.res)

    @property
    def height(self) -> int:
        return round((self.lat_max - self.lat_min) / self.res)

    @classmethod
    def metric(cls, lon_min: float, lat_min: float, lon_max: float, lat_max: float, metres: float) -> Grid:
        """Cells of so many metres of latitude."""
        return cls(lon_min, lat_min, lon_max, lat_max, metres / DEGREE_M)

    def row(self, lat: Column) -> Column:
        up = (_X(self.lat_max) - lat) if self.north_up else (lat - _X(self.lat_min))
        return F.floor(up / _X(self.res)).cast("long")

    def col(self, lon: Column) -> Column:
        return F.floor((lon - _X(self.lon_min)) / _X(self.res)).cast("long")

    def lon(self, x: Column) -> Column:
        """Longitude of cell centres."""
        return _X(self.lon_min) + (x + _X(0.5)) * _X(self.res)

    def lat(self, y: Column) -> Column:
        steps = (y + _X(0.5)) * _X(self.res)
        return _X(self.lat_max) - steps if self.north_up else _X(self.lat_min) + steps

    def holds(self, y: Column, x: Column) -> Column:
        """Whether a cell lies in the grid."""
        return y.between(0, self.height - 1) & x.between(0, self.width - 1)

    def key(self, y: Column, x: Column) -> Column:
        """One number per cell, row by row."""
        return y * _X(self.width) + x

    def unkey(self, key: Column) -> tuple[Column, Column]:
        return F.floor(key / _X(self.width)).cast("long"), F.pmod(key, _X(self.width)).cast("long")


def block_of(y: Column, x: Column, size: int = 256) -> Column:
    """Number of the square block that holds a cell; storage is partitioned and sorted by it."""
    return F.floor(y / size).cast("long") * 100_000 + F.floor(x / size).cast("long")


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return _X(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, _X(1.0))))


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Initial bearing in degrees, 0 to 360."""
    turn = F.radians(lon2 - lon1)
    y = F.sin(turn) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(turn)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, _X(360.0))


def equirect_m(lon: Column, lat: Column, mean_lat: Column) -> tuple[Column, Column]:
    """Metres east and north on a plane true at ``mean_lat``."""
    return lon * DEGREE_M * F.cos(F.radians(mean_lat)), lat * DEGREE_M


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Spherical web Mercator metres."""
    return F.radians(lon) * MERCATOR_M, F.log(F.tan(_X(math.pi / 4) + F.radians(lat) / 2)) * MERCATOR_M


def tile_xy(lon: Column, lat: Column, zoom: Column) -> tuple[Column, Column]:
    """Slippy-map tile that holds a point; numbers are cut toward zero."""
    n = F.pow(_X(2.0), zoom)
    x = ((lon + 180.0) / 360.0 * n).cast("int")
    y = ((_X(1.0) - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2.0 * n).cast("int")
    return x, y


def tile_bounds(zoom: Column, x: Column, y: Column) -> tuple[Column, Column, Column, Column]:
    """West, south, east and north of a tile in web Mercator metres."""
    span = _X(2 * math.pi * MERCATOR_M) / F.pow(_X(2.0), zoom)
    half = math.pi * MERCATOR_M
    return x * span - half, _X(half) - (y + 1) * span, (x + 1) * span - half, _X(half) - y * span


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """Inclusive containment in (lon_min, lat_min, lon_max, lat_max)."""
    return lon.between(box[0], box[2]) & lat.between(box[1], box[3])


def in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Even-odd test against an array of (x, y) structs whose last point repeats the first; null for fewer than four points."""
    at = lambda i: F.element_at(ring, i)
    crossed = F.aggregate(
        F.sequence(_X(1), F.size(ring) - 1),
        _X(0),
        lambda n, i: n
        + F.when(
            ((at(i)["y"] > lat) != (at(i + 1)["y"] > lat)) & (lon < (at(i + 1)["x"] - at(i)["x"]) * (lat - at(i)["y"]) / (at(i + 1)["y"] - at(i)["y"]) + at(i)["x"]),
            1,
        ).otherwise(0),
    )
    return F.when(F.size(ring) >= 4, crossed % 2 == 1)


def box_ring(box: tuple[float, float, float, float]) -> Column:
    """Closed ring of a box as an array of [x, y]."""
    a, b, c, d = box
    return F.array(*[F.array(_X(float(x)), _X(float(y))) for x, y in ((a, b), (c, b), (c, d), (a, d), (a, b))])
