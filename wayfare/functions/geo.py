"""Distances on the sphere, coordinate checks and the grid of the distance join."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
EARTH_RADIUS_M = 6_371_000.0
MIN_LATITUDE, MAX_LATITUDE = -90.0, 90.0
MIN_LONGITUDE, MAX_LONGITUDE = -180.0, 180.0

# Cells are this much wider than the exact bound, so rounding cannot lose a pair.
_SLACK = 1.0 + 1e-6


def distance_m(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle (haversine) distance in metres; null when a coordinate is null.

    The clamp keeps ``asin`` in range near antipodes, where rounding could exceed 1 and
    the resulting NaN would compare as larger than everything.
    """
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    # least() skips nulls, so a null chord has to be kept by hand.
    clamped = F.when(chord.isNotNull(), F.least(F.lit(1.0), chord))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(clamped))


def is_valid_location(latitude: Column, longitude: Column) -> Column:
    """True or false, never null: both coordinates present and in range."""
    in_range = latitude.between(MIN_LATITUDE, MAX_LATITUDE) & longitude.between(MIN_LONGITUDE, MAX_LONGITUDE)
    return F.coalesce(in_range, F.lit(False))


class Grid:
    """A latitude/longitude grid for a given radius, computable from one row alone.

    Two points at most ``radius_m`` apart lie in neighbouring latitude bands, and within
    the band of either point their longitudes differ by at most one cell. A band's cell
    width is the exact bound ``asin(sin(r/R) / cos(lat))`` at the band edge nearest to the
    pole, rounded up so that a whole number of cells spans the circle of latitude; near a
    pole one cell spans it all. The width depends on the band only, so neither side needs
    a pass over the data, and the date line is crossed by counting cells modulo their
    number.
    """

    def __init__(self, radius_m: float):
        if radius_m < 0:
            raise ValueError(f"radius must not be negative: {radius_m}")
        # A zero radius still needs cells of some size.
        angle = max(radius_m, 1e-3) / EARTH_RADIUS_M
        self._whole_sphere = angle >= math.pi / 2
        self._angle = min(angle, math.pi / 2)
        self._band_height = math.degrees(self._angle) * _SLACK

    def _band(self, latitude: str) -> str:
        if self._whole_sphere:
            return f"if({latitude} is null, null, 0L)"
        return f"floor({latitude} / {self._band_height!r}D)"

    def _cells_in_band(self, band: str) -> str:
        """How many cells span the band's circles of latitude, at least 1."""
        edge = f"least({MAX_LATITUDE}D, greatest(abs({band}), abs({band} + 1)) * {self._band_height!r}D)"
        # Null where the circle of the radius reaches round the pole.
        sine = f"nullif(least(1D, {math.sin(self._angle) * _SLACK!r}D / nullif(cos(radians({edge})), 0D)), 1D)"
        return f"coalesce(greatest(1L, floor(360D / (degrees(asin({sine})) * {_SLACK!r}D))), 1L)"

    @staticmethod
    def _cell_in_band(cells: str, longitude: str) -> str:
        return f"floor(({longitude} - {MIN_LONGITUDE}D) / (360D / {cells}))"

    def cell(self, latitude: str, longitude: str) -> Column:
        """The one cell ``struct(y, x)`` that holds the point in the named columns."""
        band = self._band(latitude)
        cells = self._cells_in_band(band)
        return F.expr(f"struct({band} as y, pmod({self._cell_in_band(cells, longitude)}, {cells}) as x)")

    def cells_in_reach(self, latitude: str, longitude: str) -> Column:
        """Array of distinct cells ``struct(y, x)`` that can hold a point within the radius."""
        bands = f"array({self._band(latitude)})"
        if not self._whole_sphere:
            bands = f"transform(array(-1L, 0L, 1L), step -> {self._band(latitude)} + step)"
        sized = f"transform({bands}, y -> struct(y, {self._cells_in_band('y')} as n))"
        middle = self._cell_in_band("band.n", longitude)
        around = f"array_distinct(transform(array(-1L, 0L, 1L), step -> pmod({middle} + step, band.n)))"
        return F.expr(f"flatten(transform({sized}, band -> transform({around}, x -> struct(band.y as y, x as x))))")
