"""Distances, grid cells and fault zones as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremorlake.schema import EARTH_RADIUS_KM

# Fault zones in order of precedence, open intervals of latitude
# and longitude, with the name used in the clean table and the code used in features.
FAULT_ZONES = (
    {"name": "Sesar_Sumatra", "code": 2, "lat": (-6, 6), "lon": (95, 103)},
    {"name": "Subduksi_Jawa", "code": 0, "lat": (-11, -6), "lon": (95, 120)},
    {"name": "Sesar_Palu_Koro", "code": 3, "lat": (-4, 2), "lon": (119, 124)},
    {"name": "Subduksi_Maluku", "code": 1, "lat": (-8, 2), "lon": (124, 135)},
)
OTHER_ZONE = {"name": "Lainnya_Papua", "code": 4}


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km, kept inside code generation."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), 2
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def _zone(lat: Column, lon: Column, field: str) -> Column:
    """First matching zone wins; a null coordinate lands in the last one."""

    def inside(zone: dict) -> Column:
        (south, north), (west, east) = zone["lat"], zone["lon"]
        return (lat > south) & (lat < north) & (lon > west) & (lon < east)

    chain = F.when(inside(FAULT_ZONES[0]), F.lit(FAULT_ZONES[0][field]))
    for zone in FAULT_ZONES[1:]:
        chain = chain.when(inside(zone), F.lit(zone[field]))
    return chain.otherwise(F.lit(OTHER_ZONE[field]))


def fault_zone_name(lat: Column, lon: Column) -> Column:
    return _zone(lat, lon, "name")


def fault_zone_code(lat: Column, lon: Column) -> Column:
    return _zone(lat, lon, "code")


class Grid:
    """Square cells in degrees, counted round the globe so longitude can wrap."""

    # Slack in degrees that keeps a point on a cell edge reachable despite rounding.
    SLACK = 1e-6

    def __init__(self, radius_km: float, max_degrees: float):
        self.radius_km = radius_km
        self.columns = math.ceil(360.0 / max_degrees)
        self.degrees = 360.0 / self.columns
        self.reach = math.degrees(radius_km / EARTH_RADIUS_KM)

    @classmethod
    def with_close_cells(cls, radius_km: float) -> Grid:
        """Cells so small that any two points in one are nearer than the radius."""
        diagonal = math.degrees(radius_km / EARTH_RADIUS_KM) * 0.99
        return cls(radius_km, diagonal / math.sqrt(2.0))

    @classmethod
    def about_one_radius(cls, radius_km: float) -> Grid:
        """Cells about one radius wide: a circle touches three by three of them."""
        return cls(radius_km, math.degrees(radius_km / EARTH_RADIUS_KM) * 1.1)

    def row(self, lat: Column) -> Column:
        return F.floor(lat / self.degrees)

    def column(self, lon: Column) -> Column:
        return F.pmod(F.floor(lon / self.degrees), F.lit(self.columns))

    def rows_in_reach(self, lat: Column) -> Column:
        span = self.reach + self.SLACK
        return F.sequence(self.row(lat - span), self.row(lat + span))

    def columns_in_reach(self, lat: Column, lon: Column) -> Column:
        """Columns the circle round a point can touch, by the exact bounding meridians.

        A circle that holds a pole touches every column.
        """
        ratio = F.lit(math.sin(self.radius_km / EARTH_RADIUS_KM)) / F.cos(F.radians(lat))
        holds_pole = (F.abs(lat) + self.reach >= 90.0) | (ratio >= 1.0)
        span = F.when(holds_pole, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), ratio))))
        first = F.floor((lon - span - self.SLACK) / self.degrees)
        last = F.floor((lon + span + self.SLACK) / self.degrees)
        last = F.least(last, first + F.lit(self.columns - 1))
        return F.transform(F.sequence(first, last), lambda k: F.pmod(k, F.lit(self.columns)))
