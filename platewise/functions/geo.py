"""Distances on the globe, and cells by which a join finds what lies within a distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
#: half the way around; nothing lies farther away
FARTHEST_KM = 20038.0
#: cells of level k are about 4 ** k km high; the last level covers the globe with one
LEVELS = 9


def distance_km(lat: Column, lng: Column, near: tuple[float | Column, float | Column]) -> Column:
    """Great-circle distance to a point."""
    lat0, lng0 = (F.lit(x).cast("double") for x in near)
    half_lat = F.sin(F.radians(lat.cast("double") - lat0) / 2)
    half_lng = F.sin(F.radians(lng.cast("double") - lng0) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat.cast("double"))) * F.cos(
        F.radians(lat0)
    ) * half_lng * half_lng
    return F.asin(F.sqrt(h)) * (2 * EARTH_KM)


def _height(level: Column) -> Column:
    return F.degrees(F.pow(F.lit(4.0), level) / EARTH_KM)


def _columns(band: Column, height: Column) -> Column:
    """How many cells a band has: each is at least as wide as high, down to the band's edge next to a pole."""
    low, high = F.greatest(band * height - 90, F.lit(-90.0)), F.least((band + 1) * height - 90, F.lit(90.0))
    narrow = F.least(F.cos(F.radians(low)), F.cos(F.radians(high)))
    return F.greatest(F.floor(narrow * 360 / height), F.lit(1))


def _cell(level: Column, band: Column, column: Column) -> Column:
    return ((level * 65536 + band) * 65536 + column).cast("bigint")


def _known(lat: Column, lng: Column) -> Column:
    return (F.abs(lat.cast("double")) <= 90) & (F.abs(lng.cast("double")) <= 360)


def _clipped(band: Column, height: Column) -> Column:
    return F.greatest(F.least(F.floor(band), F.floor(F.lit(180.0) / height)), F.lit(0)).cast("bigint")


def cells_of(lat: Column, lng: Column) -> Column:
    """The cell of a point on every level; empty where the point is unknown or not on the globe."""
    x = F.pmod(lng.cast("double") + 180, F.lit(360.0))

    def own(level: Column) -> Column:
        height = _height(level)
        band = _clipped((lat.cast("double") + 90) / height, height)
        n = _columns(band, height)
        return _cell(level, band, F.least(F.floor(x / 360 * n), n - 1))

    every = F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), own)
    return F.when(_known(lat, lng), every).otherwise(F.array().cast("array<bigint>"))


def cells_within(lat: Column, lng: Column, km: Column) -> Column:
    """The cells, of the level that suits the distance, that hold all points within it.

    Points that aren't within it may lie in these cells too: the distance itself has to be
    tested after the join. About a dozen cells at most, but for the few around a pole.
    """
    lat, lng = lat.cast("double"), lng.cast("double")
    reach = F.least(km.cast("double"), F.lit(FARTHEST_KM))
    level = F.ceil(F.log2(F.greatest(reach, F.lit(1.0))) / 2).cast("int")
    height = _height(level)
    # a little more than the distance, for the rounding of what follows
    up = F.degrees(reach / EARTH_KM) * (1 + 1e-9) + 1e-9
    whole = F.abs(lat) + up >= 90
    ratio = F.sin(F.radians(up)) / F.cos(F.radians(lat))
    aside = F.when(whole, 360.0).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * (1 + 1e-9) + 1e-9)
    x = F.pmod(lng + 180, F.lit(360.0))

    def in_band(band: Column) -> Column:
        n = _columns(band, height)
        first, last = F.floor((x - aside) / 360 * n), F.floor((x + aside) / 360 * n)
        return F.transform(
            F.sequence(first, F.least(last, first + n - 1)), lambda c: _cell(level, band, F.pmod(c, n))
        )

    bands = F.sequence(_clipped((lat - up + 90) / height, height), _clipped((lat + up + 90) / height, height))
    cells = F.array_distinct(F.flatten(F.transform(bands, in_band)))
    return F.when(_known(lat, lng) & (km >= 0), cells).otherwise(F.array().cast("array<bigint>"))
