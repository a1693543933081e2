"""Planar geometry on columns. Points are pairs of columns (x, y), segments two points, rectangles (x0, x1, y0, y1)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[Column, Column]
Rect = tuple[Column, Column, Column, Column]
TAU = 2 * math.pi


def inside(p: Point, r: Rect) -> Column:
    """Point in rectangle, edges included."""
    return p[0].between(r[0], r[1]) & p[1].between(r[2], r[3])


def contains_half_open(r: Rect, p: Point) -> Column:
    """Point in rectangle, upper edges excluded; a rectangle without extent on an axis asks for equality there."""
    axis = lambda lo, hi, v: F.when(lo == hi, v == lo).otherwise((lo <= v) & (v < hi))
    return axis(r[0], r[1], p[0]) & axis(r[2], r[3], p[1])


def overlaps_open(a: Rect, b: Rect) -> Column:
    """Rectangles that share more than an edge."""
    return (a[0] < b[1]) & (b[0] < a[1]) & (a[2] < b[3]) & (b[2] < a[3])


def overlaps_closed(a: Rect, b: Rect) -> Column:
    return (a[0] <= b[1]) & (b[0] <= a[1]) & (a[2] <= b[3]) & (b[2] <= a[3])


def contains(outer: Rect, inner: Rect) -> Column:
    return (outer[0] <= inner[0]) & (inner[1] <= outer[1]) & (outer[2] <= inner[2]) & (inner[3] <= outer[3])


def near(expected: Column, actual: Column) -> Column:
    """Within a ten-thousandth of the expected value, or 1e-5."""
    return F.abs(expected - actual) <= F.greatest(F.abs(expected) / 10000, F.lit(1e-5))


def bounds(p: Point, q: Point) -> Rect:
    return F.least(p[0], q[0]), F.greatest(p[0], q[0]), F.least(p[1], q[1]), F.greatest(p[1], q[1])


def length(p: Point, q: Point) -> Column:
    return F.hypot(q[0] - p[0], q[1] - p[1])


def dot(p: Point, q: Point) -> Column:
    return p[0] * q[0] + p[1] * q[1]


def direction(p: Point, q: Point) -> Column:
    """Radians in [0, 2 pi) from p to q; null where they agree."""
    return F.when((p[0] != q[0]) | (p[1] != q[1]), normalised(F.atan2(q[1] - p[1], q[0] - p[0])))


def normalised(angle: Column) -> Column:
    return F.pmod(angle, F.lit(TAU))


def angle_between(a: Column, b: Column) -> Column:
    """Angle between two directions, in [0, pi]; null if either is."""
    d = F.abs(normalised(a) - normalised(b))
    return F.when(d > math.pi, TAU - d).otherwise(d)


def clip_interval(p: Point, q: Point, r: Rect) -> tuple[Column, Column, Column]:
    """(start, end, hit): the part of the segment within the closed rectangle, as shares of its length."""
    lo, hi = F.lit(0.0), F.lit(1.0)
    hit = F.lit(True)
    for k, (low, high) in enumerate(((r[0], r[1]), (r[2], r[3]))):
        d = q[k] - p[k]
        t0, t1 = (low - p[k]) / F.nullif(d, F.lit(0.0)), (high - p[k]) / F.nullif(d, F.lit(0.0))
        lo = F.greatest(lo, F.coalesce(F.least(t0, t1), F.lit(0.0)))
        hi = F.least(hi, F.coalesce(F.greatest(t0, t1), F.lit(1.0)))
        hit = hit & ((d != 0) | p[k].between(low, high))
    return lo, hi, hit & (lo <= hi)


def clip(p: Point, q: Point, r: Rect) -> tuple[Point, Point, Column]:
    lo, hi, hit = clip_interval(p, q, r)
    at = lambda t: tuple(F.when(hit, p[k] + t * (q[k] - p[k])) for k in (0, 1))
    return at(lo), at(hi), hit


def foot(p: Point, q: Point, c: Point) -> Column:
    """Where the perpendicular from c meets the line through p and q, as a share of the segment; null for a segment without length."""
    dx, dy = q[0] - p[0], q[1] - p[1]
    return ((c[0] - p[0]) * dx + (c[1] - p[1]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))


def closest(p: Point, q: Point, c: Point) -> tuple[Column, Column, Column, Column]:
    """(x, y, distance, perpendicular) of the point of the segment that is closest to c."""
    t = foot(p, q, c)
    at = lambda k: F.when(t < 0, p[k]).when(t > 1, q[k]).otherwise(p[k] + t * (q[k] - p[k]))
    # Measured from the segment's start, not from the foot's rounded place, so that near ties come out by their true order.
    off = lambda k: F.when(t < 0, c[k] - p[k]).when(t > 1, c[k] - q[k]).otherwise(c[k] - p[k] - t * (q[k] - p[k]))
    return at(0), at(1), F.sqrt(F.pow(off(0), F.lit(2.0)) + F.pow(off(1), F.lit(2.0))), t.between(0, 1)


def intersection(p1: Point, q1: Point, p2: Point, q2: Point) -> Point:
    """Where two lines meet; null for parallel ones."""
    ax, ay, bx, by = q1[0] - p1[0], q1[1] - p1[1], q2[0] - p2[0], q2[1] - p2[1]
    t = ((p2[0] - p1[0]) * by - (p2[1] - p1[1]) * bx) / F.nullif(ax * by - ay * bx, F.lit(0.0))
    return p1[0] + t * ax, p1[1] + t * ay


def nearest_on_line(p: Point, q: Point, c: Point) -> Point:
    t = foot(p, q, c)
    return p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])


def bucket(value: Column, low: Column, extent: Column, n: int) -> Column:
    """Histogram bucket; truncates toward zero, so values just below low fall in bucket 0."""
    return ((value - low) / extent * n).cast("int")


class Affine:
    """Affine map of the plane with constant coefficients: x' = a x + b y + c, y' = d x + e y + f."""

    def __init__(self, a: float = 1, b: float = 0, c: float = 0, d: float = 0, e: float = 1, f: float = 0):
        self.m = (a, b, c, d, e, f)

    def then(self, other: Affine) -> Affine:
        a, b, c, d, e, f = self.m
        p, q, r, s, t, u = other.m
        return Affine(p * a + q * d, p * b + q * e, p * c + q * f + r, s * a + t * d, s * b + t * e, s * c + t * f + u)

    @classmethod
    def rotation(cls, angle: float) -> Affine:
        """Clockwise for positive angles."""
        return cls(math.cos(angle), math.sin(angle), 0, -math.sin(angle), math.cos(angle), 0)

    @classmethod
    def translation(cls, dx: float, dy: float) -> Affine:
        return cls(c=dx, f=dy)

    @classmethod
    def scale(cls, sx: float, sy: float) -> Affine:
        return cls(a=sx, e=sy)

    def inverse(self) -> Affine:
        a, b, c, d, e, f = self.m
        det = a * e - b * d
        if not det:
            raise ValueError("the map has no inverse")
        return Affine(e / det, -b / det, (b * f - c * e) / det, -d / det, a / det, (c * d - a * f) / det)

    def __call__(self, p: Point) -> Point:
        a, b, c, d, e, f = self.m
        return p[0] * a + p[1] * b + c, p[0] * d + p[1] * e + f
