"""Geodesy on columns: latitudes and longitudes in degrees, distances in metres, headings in degrees clockwise from north.

The earth's radius depends on the latitude: EQUATOR - FLATTENING * abs(sin(latitude)).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Equatorial radius in metres and how much smaller it is at the poles.
EQUATOR, FLATTENING = 6378137.0, 21384.7
#: Local coordinates hold within this distance of their centre.
LOCAL_LIMIT = 50_000.0


def heading_or_invalid(heading: Column) -> Column:
    """The heading where it is accepted (-2 to 360), else -1."""
    return F.when(heading.between(-2, 360), heading).otherwise(F.lit(-1))


def heading_valid(heading: Column) -> Column:
    return heading.between(0, 360)


def latitude_valid(lat: Column) -> Column:
    return lat.between(-90.0, 90.0) & ~F.isnan(lat)


def longitude_valid(lon: Column) -> Column:
    return lon.between(-180.0, 180.0) & ~F.isnan(lon)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def earth_radius(lat: Column) -> Column:
    return F.lit(EQUATOR) - F.lit(FLATTENING) * F.abs(F.sin(F.radians(lat)))


def _arc(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    u, v = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    a = u * u + v * v * F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    return 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; beyond half a radian the radius is that of the first point, so the order then matters."""
    arc = _arc(lat1, lon1, lat2, lon2)
    return F.when(arc < 0.5, earth_radius((lat1 + lat2) / 2)).otherwise(earth_radius(lat1)) * arc


def heading(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Heading at the first point of the great circle to the second."""
    p1, p2, dl = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    y = F.sin(dl) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360, F.lit(360.0))


def destination(lat: Column, lon: Column, metres: Column, toward: Column) -> tuple[Column, Column]:
    """(latitude, longitude) at a distance and heading."""
    p, b, d = F.radians(lat), F.radians(toward), metres / earth_radius(lat)
    p2 = F.asin(F.sin(p) * F.cos(d) + F.cos(p) * F.sin(d) * F.cos(b))
    turn = F.atan2(F.sin(b) * F.sin(d) * F.cos(p), F.cos(d) - F.sin(p) * F.sin(p2))
    return F.degrees(p2), F.degrees(F.radians(lon) + turn)


def _step(low: Column, high: Column) -> Column:
    return earth_radius((low + high) / 2) * (2 * math.pi) * ((high - low) / 360)


def meridian_arc(lat1: Column, lat2: Column) -> Column:
    """Length along a meridian: one step below half a degree, else steps of a quarter."""
    low, high = F.least(lat1, lat2), F.greatest(lat1, lat2)
    whole = F.greatest(F.ceil((high - low) / 0.25) - 1, F.lit(0)).cast("int")
    starts = F.when(whole > 0, F.sequence(F.lit(0), whole - 1)).otherwise(F.array().cast("array<int>"))
    steps = F.aggregate(starts, F.lit(0.0), lambda total, i: total + _step(low + i * 0.25, low + i * 0.25 + 0.25))
    return F.when(high - low < 0.5, _step(low, high)).otherwise(steps + _step(low + whole * 0.25, high))


def cap_area(lat: Column) -> Column:
    """Area of the earth north of a latitude."""
    return earth_radius(lat) * earth_radius(lat) * (2 * math.pi) * (1 - F.sin(F.radians(lat)))


def rect_area(south: Column, north: Column, west: Column, east: Column) -> Column:
    return (cap_area(south) - cap_area(north)) * ((east - west) / 360)


def width_at(lat: Column, west: Column, east: Column) -> Column:
    """The width that the rectangle's share of the parallel has, with the parallel's length taken as radius times cosine."""
    return earth_radius(lat) * F.cos(F.radians(lat)) * ((east - west) / 360)


def middle_width(south: Column, north: Column, west: Column, east: Column) -> Column:
    """Width half way between south and north (the intent: half the sum, not half the difference)."""
    return width_at((south + north) / 2, west, east)


def expand(south: Column, north: Column, west: Column, east: Column, margin: Column) -> tuple[Column, Column, Column, Column]:
    """South, north, west, east of the rectangle moved out by a margin in metres, measured at two of its corners."""
    at = lambda lat, lon, h: destination(lat, lon, margin, F.lit(float(h)))
    return at(south, east, 180)[0], at(north, west, 0)[0], at(north, west, 270)[1], at(south, east, 90)[1]


def bisected_area(south: Column, north: Column, west: Column, east: Column, depth: int = 4) -> Column:
    """Area by trapezoids, halved until any two of the three widths are within 2 % (any, not all: that is the defined result).

    depth bounds the halving; at city scale the first level always ends it.
    """
    wide = lambda lat: distance(lat, west, lat, east)

    def part(low: Column, high: Column, height: Column, w_low: Column, w_high: Column, left: int) -> Column:
        mid = (low + high) / 2
        w_mid, half = wide(mid), height / 2
        near = (F.abs(w_mid / w_low - 1) <= 0.02) | (F.abs(w_mid / w_high - 1) <= 0.02) | (F.abs(w_high / w_low - 1) <= 0.02)
        flat = half * (w_low + w_mid) / 2 + half * (w_mid + w_high) / 2
        if not left:
            return flat
        return F.when(near, flat).otherwise(part(low, mid, half, w_low, w_mid, left - 1) + part(mid, high, half, w_mid, w_high, left - 1))

    return part(south, north, distance(south, west, north, west), wide(south), wide(north), depth)


def _tenths(x: Column) -> Column:
    """Whole tenths nearest to x >= 0, by its binary value and to even ones, as C and Go print %.1f (Java rounds the decimal text, half up)."""
    tenfold = x * 10
    lost = x * 2 - (tenfold - x * 8)  # exactly what the rounded product lacks
    whole = F.floor(tenfold)
    over = tenfold - whole - 0.5
    return whole + F.when((over > 0) | ((over == 0) & ((lost > 0) | ((lost == 0) & (whole % 2 == 1)))), 1).otherwise(0)


def dms(x: Column, negative: str, positive: str) -> Column:
    """Degrees, minutes and seconds as d.mm.ss.s with a letter for the side."""
    v = F.abs(x)
    minutes = (v - F.floor(v)) * 60
    tenths = _tenths((minutes - F.floor(minutes)) * 60)
    return F.format_string("%d.%02d.%02d.%d%s", F.floor(v), F.floor(minutes), F.floor(tenths / 10), tenths % 10, F.when(x < 0, negative).otherwise(positive))


def to_direction(toward: Column) -> Column:
    """Radians counterclockwise from east of a heading; null outside 0 to 360."""
    return F.when(heading_valid(toward), F.radians(F.pmod(90 - toward.cast("double"), F.lit(360.0))))


def from_direction(direction: Column) -> Column:
    return F.pmod(90 - F.degrees(direction), F.lit(360.0))


def to_local(lat: Column, lon: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """Metres east and north of a centre, polar about it."""
    d, h = distance(lat0, lon0, lat, lon), heading(lat0, lon0, lat, lon)
    angle = F.radians(F.pmod(90 - h, F.lit(360.0)))
    return F.cos(angle) * d, F.sin(angle) * d


def from_local(x: Column, y: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """Latitude and longitude of local metres; null beyond LOCAL_LIMIT."""
    d = F.hypot(x, y)
    lat, lon = destination(lat0, lon0, d, from_direction(F.atan2(y, x)))
    return F.when(d <= LOCAL_LIMIT, lat), F.when(d <= LOCAL_LIMIT, lon)
