"""Golden values and properties of the column functions."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetloom.functions import geo, geom, when, xml

NW, NE, SW, SE = (42.4628099, -71.29118), (42.4628099, -71.14248), (42.3954299, -71.29118), (42.3954299, -71.14248)
HIGHLAND, HILLCREST, BELLINGTON, PARK = (42.40961, -71.17413), (42.4104999, -71.17731), (42.4109099, -71.17965), (42.4112499, -71.18156)
DISTANCES = [
    (NW, NE, 89.95, 270.05, 12183.919), (SW, SE, 89.95, 270.05, 12197.058), (NW, SW, 180, 0, 7483.740), (NE, SE, 180, 0, 7483.740),
    (HIGHLAND, HILLCREST, 290.759, 110.76, 278.880), (HILLCREST, BELLINGTON, 283.35, 103.35, 197.220), (HIGHLAND, BELLINGTON, 287.69, 107.69, 475.135), (BELLINGTON, PARK, 283.56, 103.55, 161.116),
]
c = F.col


def lit(*v):
    return tuple(F.lit(float(x)) for x in v)


def one(spark, *cols):
    return tuple(spark.range(1).select(*(x.alias(f"c{i}") for i, x in enumerate(cols))).first())


def test_distances_and_headings(spark):
    for a, b, there, back, metres in DISTANCES:
        p, q = lit(*a), lit(*b)
        d, h, r = one(spark, geo.distance(*p, *q), geo.heading(*p, *q), geo.heading(*q, *p))
        assert d == pytest.approx(metres, abs=0.001)
        assert math.cos(math.radians(h - there)) > 1 - 1e-7 and math.cos(math.radians(r - back)) > 1 - 1e-7
        lat, lon = one(spark, *geo.destination(*p, F.lit(d), F.lit(h)))
        assert (lat, lon) == (pytest.approx(b[0], abs=1e-4), pytest.approx(b[1], abs=1e-4))
        x, y = geo.to_local(*q, *p)
        lat, lon = one(spark, *geo.from_local(x, y, *p))
        assert (lat, lon) == (pytest.approx(b[0], abs=1e-4), pytest.approx(b[1], abs=1e-4))


def test_headings_to_directions(spark):
    for h, quarter in [(0, 2), (45, 1), (90, 0), (135, 7), (180, 6), (225, 5), (270, 4), (315, 3), (360, 2)]:
        d, back = one(spark, geo.to_direction(F.lit(h)), geo.from_direction(geo.to_direction(F.lit(h))))
        assert d == pytest.approx(quarter * math.pi / 4) and back == pytest.approx(h % 360, abs=1e-9)
    assert one(spark, geo.to_direction(F.lit(-45)), geo.heading_or_invalid(F.lit(400)), geo.heading_or_invalid(F.lit(-2))) == (None, -1, -2)


def test_areas_agree(spark):
    rect = lit(42.1, 42.4, -71.3, -71.0)
    a, b = one(spark, geo.rect_area(*rect), geo.bisected_area(*rect))
    assert a == pytest.approx(b, rel=0.01)
    assert one(spark, geo.meridian_arc(F.lit(42.0), F.lit(43.3)))[0] == pytest.approx(one(spark, geo.distance(*lit(42, 0, 43.3, 0)))[0], rel=1e-4)


CLIPS = [
    ((-0.5, -10, -0.5, 10), (-0.5, -1, -0.5, 1)), ((-1, -1, 1, 1), (-1, -1, 1, 1)), ((0, 0, 0.1, 0.2), (0, 0, 0.1, 0.2)), ((-2, -10, -2, 10), None),
    ((1.0000001, -10, 1, 10), None), ((11, -9, -9, 11), (1, 1, 1, 1)), ((10.9, -9, -9.1, 11), (1, 0.9, 0.9, 1)),
]


@pytest.mark.parametrize(("segment", "part"), CLIPS)
def test_clip(spark, segment, part):
    s = lit(*segment)
    a, b, hit = geom.clip(s[:2], s[2:], lit(-1, 1, -1, 1))
    got = one(spark, hit, *a, *b)
    if segment == (1.0000001, -10, 1, 10):  # touches at its end only
        assert not got[0] or got[1] == pytest.approx(1, abs=1e-6)
    elif part is None:
        assert not got[0]
    else:
        assert got[0] and got[1:] == pytest.approx(part)


def test_point_segment_distances(spark):
    a, b, cc, d, e, f, m = (0, 0), (1, 0), (0, 1), (1, 1), (0.70711, 0.70711), (-0.70711, 0.70711), (0.5, 0)
    for p, q, x, want in [(a, b, a, 0), (a, b, b, 0), (a, b, m, 0), (a, b, cc, 1), (a, b, d, 1), (a, b, e, 0.70711), (a, m, b, 0.5), (a, b, f, 1)]:
        for s, t in ((p, q), (q, p)):
            assert one(spark, geom.closest(lit(*s), lit(*t), lit(*x))[2])[0] == pytest.approx(want, abs=1e-4)
    assert one(spark, geom.closest(lit(1, 1), lit(1, 1), lit(0, 0))[2])[0] is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-10, 10).map(lambda x: round(x, 3)), min_size=6, max_size=6))
def test_affine_inverse(v):
    m = geom.Affine(*v)
    det = v[0] * v[4] - v[1] * v[3]
    if abs(det) > 0.1:
        both = m.then(m.inverse()).m
        assert both == pytest.approx((1, 0, 0, 0, 1, 0), abs=1e-6)


def test_angles_and_lines(spark):
    assert one(spark, geom.angle_between(*lit(0.1, 6.2)))[0] == pytest.approx(0.1 + 2 * math.pi - 6.2)
    assert one(spark, *geom.intersection(lit(0, 0), lit(1, 1), lit(0, 2), lit(2, 0))) == pytest.approx((1, 1))
    assert one(spark, *geom.intersection(lit(0, 0), lit(1, 1), lit(0, 1), lit(1, 2))) == (None, None)
    assert one(spark, geom.direction(lit(1, 1), lit(1, 1)))[0] is None
    assert one(spark, geom.bucket(F.lit(-0.01), F.lit(0.0), F.lit(1.0), 10), geom.bucket(F.lit(1.0), F.lit(0.0), F.lit(1.0), 10)) == (0, 10)


def test_times(spark):
    ms = F.lit(1350562779906).cast("long")
    assert one(spark, when.stamp(ms), when.stamp(ms, "America/New_York"), when.name_to_time(F.lit("1350562779906.xml"))) == ("20121018 121939", "20121018 081939", "121939.906.xml")
    midnight = F.lit(1350518400000).cast("long")
    assert [str(x) for x in one(spark, when.archive_day(midnight), when.day(midnight))] == ["2012-10-17", "2012-10-18"]
    assert one(spark, when.dashed_date(F.lit("20121018_raw")), when.dashed_date(F.lit("201210189"))) == ("2012-10-18_raw", "201210189")


def test_xml_text(spark):
    doc = '\n<?xml version="1.0"?>\n<!-- a\nb -->\n<body x="1"><!--c--> <a/></body>'
    got = one(spark, xml.root_offset(F.lit(doc)), xml.strip_comments(F.lit(doc)), xml.comments(F.lit(doc)), xml.root_offset(F.lit("none")))
    assert doc[got[0] :].startswith("<body") and "<!--" not in got[1] and got[2] == [" a\nb ", "c"] and got[3] is None
    paths = ["b/x", "a", "b/a/z", "c", "b/y"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string").orderBy(xml.path_key(c("p"))).collect()
    assert [r.p for r in rows] == ["a", "c", "b/x", "b/y", "b/a/z"]


def test_times_as_people_write_them(spark):
    now = F.lit("2013-06-14 13:30:00").cast("timestamp_ntz")  # a Friday
    want = {
        "2013-06-14 15:00:00": "3pm", "2013-06-14 15:04:00": "3:04pm", "2013-06-14 15:04:05": "3:04:05pm", "2013-06-14 15:04:05.25": "3:04:05.25pm", "2013-06-15 00:00:00": "midnight",
        "2013-06-15 12:00:00": "tomorrow at noon", "2013-06-16 00:00:00": "tomorrow at midnight", "2013-06-16 09:00:00": "Sunday at 9am", "2013-06-17 00:00:00": "Monday at midnight",
        "2013-06-20 01:00:00": "Thursday at 1am", "2013-06-21 00:00:00": "Friday at midnight", "2013-06-21 08:15:00": "2013-06-21 at 8:15am", "2013-06-14 13:30:00": "2013-06-14T13:30:00Z", "2013-06-13 01:02:03.5": "2013-06-13T01:02:03.5Z",
    }
    got = one(spark, *(when.human(now, F.lit(t).cast("timestamp_ntz")) for t in want))
    assert list(got) == list(want.values())


def test_seconds_of_degrees_are_rounded_as_c_prints_them(spark):
    rng = random.Random(5)
    # Exact halves, tenths' halves that binary misses on either side, the carry to 60.0, and any others.
    seconds = [*(k / 4 for k in range(240)), *(k / 20 for k in range(1200)), *(rng.random() * 60 for _ in range(2000)), 59.95, math.nextafter(59.95, 60), 1e-300]
    tenths = spark.createDataFrame([(s,) for s in seconds], "s double").select("s", geo._tenths(c("s")).alias("k")).collect()
    assert [(r.s, r.k) for r in tenths] == [(r.s, round(float(f"{r.s:.1f}") * 10)) for r in tenths]
    degrees = [0.0, -70.953125, 71.01562500000001, 70.99999999, 0.5, -179.999999]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(degrees)], "i int, v double").select("i", geo.dms(c("v"), "W", "E").alias("d")).orderBy("i").collect()

    def printed(v):
        minutes = (abs(v) - math.floor(abs(v))) * 60
        return f"{math.floor(abs(v))}.{math.floor(minutes):02d}.{(minutes - math.floor(minutes)) * 60:04.1f}{'W' if v < 0 else 'E'}"

    assert [r.d for r in got] == [printed(v) for v in degrees]
    assert got[1].d == "70.57.11.2W"


def test_closest_orders_near_ties_by_exact_distance(spark):
    # Reports beside the corners of zigzags, as far from one road as from the next but for the rounding of their places.
    rng = random.Random(3)
    rows = []
    for i in range(400):
        x, y, h = -71.2 + rng.randrange(40) * 8e-3, 42.1 + rng.randrange(40) * 3e-3, 6e-3 * rng.choice((-1, 1))
        rows.append((i, x, y, x + 8e-3, y + h, x + 16e-3, y, x + 8e-3, y + h - math.copysign(rng.randrange(1, 1000) / 1e6, h)))
    df = spark.createDataFrame(rows, "i int, ax double, ay double, bx double, by double, zx double, zy double, x double, y double")
    a, b, z, at = ((c(f"{k}x"), c(f"{k}y")) for k in ("a", "b", "z", ""))
    got = {r.i: (r.one, r.two) for r in df.select("i", geom.closest(a, b, at)[2].alias("one"), geom.closest(b, z, at)[2].alias("two")).collect()}

    def exact(px, py, qx, qy, x, y):
        px, py, qx, qy, x, y = map(Fraction, (px, py, qx, qy, x, y))
        t = min(max(((x - px) * (qx - px) + (y - py) * (qy - py)) / ((qx - px) ** 2 + (qy - py) ** 2), 0), 1)
        return (x - px - t * (qx - px)) ** 2 + (y - py - t * (qy - py)) ** 2

    for i, ax, ay, bx, by, zx, zy, x, y in rows:
        for d, e in zip(got[i], (exact(ax, ay, bx, by, x, y), exact(bx, by, zx, zy, x, y)), strict=True):
            assert abs(Fraction(d) ** 2 - e) < 2 * Fraction(d) / 10**16, (i, d)  # coordinates have steps of 7e-15 and 1.4e-14
