"""Queries of predicates and scalar functions over the report and path views."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, geom, when, xml
from ..operators import stats
from .fixtures import over_views, path_segments, table, vehicle_reports
from .core import query

c = F.col
# The centre of the local coordinates, a test rectangle (x0, x1, y0, y1) and a margin in metres.
LAT0, LON0 = 42.2, -71.05
RECT = (-71.2, -71.0, 42.1, 42.3)


def _rect() -> geom.Rect:
    return tuple(F.lit(v) for v in RECT)


def _seg() -> tuple[geom.Point, geom.Point]:
    return (c("lon1"), c("lat1")), (c("lon2"), c("lat2"))



def _round(**cols) -> list:
    return [F.round(v, 6).alias(k) for k, v in cols.items()]


# DuckDB texts for formulas that several oracles share.
_RAD = "(6378137e0 - 213847e-1 * abs(sin(radians({0}))))"


def _sql_arc(a: str, b: str, x: str, y: str) -> str:
    u, v = f"power(sin(radians(({x}) - ({a})) / 2), 2)", f"power(sin(radians(({y}) - ({b})) / 2), 2)"
    h = f"({u} + {v} * cos(radians({a})) * cos(radians({x})))"
    return f"(2 * atan2(sqrt({h}), sqrt(1 - {h})))"


def sql_distance(a: str, b: str, x: str, y: str) -> str:
    arc = _sql_arc(a, b, x, y)
    return f"({arc} * CASE WHEN {arc} < 5e-1 THEN {_RAD.format(f'((({a}) + ({x})) / 2)')} ELSE {_RAD.format(a)} END)"


def sql_heading(a: str, b: str, x: str, y: str) -> str:
    dl = f"radians(({y}) - ({b}))"
    return f"fmod(degrees(atan2(sin({dl}) * cos(radians({x})), cos(radians({a})) * sin(radians({x})) - sin(radians({a})) * cos(radians({x})) * cos({dl}))) + 360, 360)"


def sql_clip(px: str, py: str, qx: str, qy: str, x0: str, x1: str, y0: str, y1: str) -> tuple[str, str]:
    """(start, end) of the clipped part; it is empty where start > end."""
    lo, hi = [], []
    for p, q, a, b in ((px, qx, x0, x1), (py, qy, y0, y1)):
        d = f"(({q}) - ({p}))"
        s, t = f"((({a}) - ({p})) / {d})", f"((({b}) - ({p})) / {d})"
        stays = f"CASE WHEN ({p}) BETWEEN ({a}) AND ({b}) THEN {{0}} ELSE {{1}} END"
        lo.append(f"CASE WHEN {d} = 0 THEN {stays.format('0e0', '2e0')} ELSE least({s}, {t}) END")
        hi.append(f"CASE WHEN {d} = 0 THEN {stays.format('1e0', '-1e0')} ELSE greatest({s}, {t}) END")
    return f"greatest(0e0, {lo[0]}, {lo[1]})", f"least(1e0, {hi[0]}, {hi[1]})"


@query("p01_heading_valid", over_views("SELECT event_id, CASE WHEN heading >= -2 AND heading <= 360 THEN heading ELSE -1 END AS heading, heading >= 0 AND heading <= 360 AS is_valid FROM vehicle_reports"))
def p01(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("event_id", geo.heading_or_invalid(c("heading")).alias("heading"), geo.heading_valid(c("heading")).alias("is_valid"))


@query("p02_latlon_clamp", over_views("SELECT event_id, round(least(90e0, greatest(-90e0, lat * 22e-1)), 6) AS lat, abs(lat * 22e-1) <= 90 AS lat_valid, round(least(180e0, greatest(-180e0, lon * 3)), 6) AS lon, abs(lon * 3) <= 180 AS lon_valid FROM vehicle_reports"))
def p02(spark: SparkSession, d: str) -> DataFrame:
    lat, lon = c("lat") * 2.2, c("lon") * 3
    return vehicle_reports(spark, d).select("event_id", F.round(geo.clamp(lat, -90.0, 90.0), 6).alias("lat"), geo.latitude_valid(lat).alias("lat_valid"), F.round(geo.clamp(lon, -180.0, 180.0), 6).alias("lon"), geo.longitude_valid(lon).alias("lon_valid"))


@query("p03_in_rect", over_views("SELECT event_id FROM vehicle_reports WHERE lon >= -712e-1 AND lon <= -71e0 AND lat >= 421e-1 AND lat <= 423e-1"))
def p03(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).filter(geom.inside((c("lon"), c("lat")), _rect())).select("event_id")


@query("p04_rect_half_open", "SELECT event_id, (user_id >= 10 AND user_id < 40 AND event_id % 7 >= 2 AND event_id % 7 < 5) AS in_rect, (user_id = 10 AND event_id % 7 >= 2 AND event_id % 7 < 5) AS in_line FROM events")
def p04(spark: SparkSession, d: str) -> DataFrame:
    p = c("user_id"), c("event_id") % 7
    r = lambda *v: geom.contains_half_open(tuple(F.lit(x) for x in v), p)
    return table(spark, d, "events").select("event_id", r(10, 40, 2, 5).alias("in_rect"), r(10, 10, 2, 5).alias("in_line"))


_BOX_SQL = "least(lon1, lon2) AS x0, greatest(lon1, lon2) AS x1, least(lat1, lat2) AS y0, greatest(lat1, lat2) AS y1"


@query("p05_rect_overlap", over_views("SELECT path_index, seg_index, x0 < -71e0 AND -712e-1 < x1 AND y0 < 423e-1 AND 421e-1 < y1 AS overlaps FROM b", f"b AS (SELECT *, {_BOX_SQL} FROM path_segments)"))
def p05(spark: SparkSession, d: str) -> DataFrame:
    return path_segments(spark).select("path_index", "seg_index", geom.overlaps_open(geom.bounds(*_seg()), _rect()).alias("overlaps"))


@query("p06_rect_contains", over_views("SELECT path_index, seg_index, -712e-1 <= x0 AND x1 <= -71e0 AND 421e-1 <= y0 AND y1 <= 423e-1 AS contained FROM b", f"b AS (SELECT *, {_BOX_SQL} FROM path_segments)"))
def p06(spark: SparkSession, d: str) -> DataFrame:
    return path_segments(spark).select("path_index", "seg_index", geom.contains(_rect(), geom.bounds(*_seg())).alias("contained"))


@query("p07_same_reports", over_views("SELECT event_id, heading = ph AS same_heading, coalesce(abs(unix_ms - pm) <= 3600000, false) AS almost_same_time, route_tag = pr AND dir_tag = pd AND heading = ph AS same_but_time FROM l", "l AS (SELECT *, lag(heading) OVER w AS ph, lag(unix_ms) OVER w AS pm, lag(route_tag) OVER w AS pr, lag(dir_tag) OVER w AS pd FROM vehicle_reports WINDOW w AS (PARTITION BY vehicle_id ORDER BY unix_ms, event_id))"))
def p07(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("vehicle_id").orderBy("unix_ms", "event_id")
    prev = lambda x: F.lag(x).over(w)
    same = (c("route_tag") == prev("route_tag")) & (c("dir_tag") == prev("dir_tag")) & (c("heading") == prev("heading"))
    return vehicle_reports(spark, d).select("event_id", (c("heading") == prev("heading")).alias("same_heading"), F.coalesce(F.abs(c("unix_ms") - prev("unix_ms")) <= 3600000, F.lit(False)).alias("almost_same_time"), same.alias("same_but_time"))


@query("p08_near_equal", "SELECT l_orderkey, l_linenumber, abs(l_extendedprice - l_quantity * 1500) <= greatest(abs(l_extendedprice) / 10000, 1e-5) AS near FROM lineitem")
def p08(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", geom.near(c("l_extendedprice"), c("l_quantity") * 1500).alias("near"))


@query("p09_order_violations", "SELECT o_orderkey, o_custkey FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM orders) WHERE m > o_orderdate")
def p09(spark: SparkSession, d: str) -> DataFrame:
    return stats.order_violations(table(spark, d, "orders"), "o_orderdate", ["o_custkey"], ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("p11_valid_heading", over_views("SELECT dir_tag, count(*) AS reports FROM vehicle_reports WHERE heading BETWEEN 0 AND 360 GROUP BY dir_tag"))
def p11(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).filter(geo.heading_valid(c("heading"))).groupBy("dir_tag").agg(F.count("*").alias("reports"))


@query("g01_radians", over_views("SELECT event_id, round(radians(lat), 9) AS lat_rad, round(degrees(radians(lon)), 6) AS lon_deg FROM vehicle_reports"))
def g01(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("event_id", F.round(F.radians("lat"), 9).alias("lat_rad"), F.round(F.degrees(F.radians("lon")), 6).alias("lon_deg"))


@query("g02_earth_radius", over_views(f"SELECT event_id, round({_RAD.format('lat')}, 4) AS radius FROM vehicle_reports"))
def g02(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("event_id", F.round(geo.earth_radius(c("lat")), 4).alias("radius"))


@query("g03_haversine", over_views(f"SELECT event_id, round({sql_distance('422e-1', '-7105e-2', 'lat', 'lon')}, 4) AS metres, round({sql_heading('422e-1', '-7105e-2', 'lat', 'lon')}, 6) AS heading, round({sql_distance('lat', 'lon', '-lat', 'lon + 90')}, 3) AS far_metres FROM vehicle_reports"))
def g03(spark: SparkSession, d: str) -> DataFrame:
    a = F.lit(LAT0), F.lit(LON0), c("lat"), c("lon")
    far = geo.distance(c("lat"), c("lon"), -c("lat"), c("lon") + 90)
    return vehicle_reports(spark, d).select("event_id", F.round(geo.distance(*a), 4).alias("metres"), F.round(geo.heading(*a), 6).alias("heading"), F.round(far, 3).alias("far_metres"))


_DEST = f"""d AS (SELECT event_id, lat, lon, heading, radians(lat) AS p, radians(heading) AS b, 25e2 / {_RAD.format('lat')} AS a FROM vehicle_reports),
f AS (SELECT *, asin(sin(p) * cos(a) + cos(p) * sin(a) * cos(b)) AS p2 FROM d)"""


@query("g04_destination", over_views("SELECT event_id, round(degrees(p2), 7) AS lat, round(degrees(radians(lon) + atan2(sin(b) * sin(a) * cos(p), cos(a) - sin(p) * sin(p2))), 7) AS lon FROM f", _DEST))
def g04(spark: SparkSession, d: str) -> DataFrame:
    lat, lon = geo.destination(c("lat"), c("lon"), F.lit(2500.0), c("heading"))
    return vehicle_reports(spark, d).select("event_id", F.round(lat, 7).alias("lat"), F.round(lon, 7).alias("lon"))


_STEP = f"({_RAD.format('(({0} + {1}) / 2)')} * 2 * pi() * (({{1}} - {{0}}) / 36e1))".replace("{{", "{").replace("}}", "}")


@query(
    "g05_meridian_arc",
    over_views(
        f"""SELECT event_id, round(CASE WHEN hi - lo < 5e-1 THEN {_STEP.format('lo', 'hi')}
        ELSE (SELECT sum(CASE WHEN lo + (i + 1) * 25e-2 >= hi THEN {_STEP.format('(lo + i * 25e-2)', 'hi')} ELSE {_STEP.format('(lo + i * 25e-2)', '(lo + i * 25e-2 + 25e-2)')} END)
              FROM (SELECT unnest(range(0, 40)) AS i) WHERE lo + i * 25e-2 < hi) END, 3) AS metres FROM a""",
        "a AS (SELECT event_id, least(lat, 415e-1 + (event_id % 30) / 1e1) AS lo, greatest(lat, 415e-1 + (event_id % 30) / 1e1) AS hi FROM vehicle_reports)",
    ),
)
def g05(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("event_id", F.round(geo.meridian_arc(c("lat"), F.lit(41.5) + (c("event_id") % 30) / 10.0), 3).alias("metres"))


_CAP = f"(2 * pi() * {_RAD} * {_RAD} * (1 - sin(radians({{0}}))))"


@query(
    "g06_rect_area",
    over_views(
        f"""SELECT path_index, seg_index, round(({_CAP.format('y0')} - {_CAP.format('y1')}) * ((x1 - x0) / 36e1) / 1e6, 5) AS km2,
        round({_RAD.format('((y0 + y1) / 2)')} * cos(radians((y0 + y1) / 2)) * ((x1 - x0) / 36e1), 5) AS middle_width, round((x0 + x1) / 2, 6) AS center_lon, round((y0 + y1) / 2, 6) AS center_lat FROM b""",
        f"b AS (SELECT path_index, seg_index, {_BOX_SQL} FROM path_segments)",
    ),
)
def g06(spark: SparkSession, d: str) -> DataFrame:
    x0, x1, y0, y1 = geom.bounds(*_seg())
    return path_segments(spark).select("path_index", "seg_index", F.round(geo.rect_area(y0, y1, x0, x1) / 1e6, 5).alias("km2"), F.round(geo.middle_width(y0, y1, x0, x1), 5).alias("middle_width"), F.round((x0 + x1) / 2, 6).alias("center_lon"), F.round((y0 + y1) / 2, 6).alias("center_lat"))


def _sql_dest(lat: str, lon: str, m: str, h: str) -> tuple[str, str]:
    a = f"({m} / {_RAD.format(lat)})"
    p2 = f"asin(sin(radians({lat})) * cos({a}) + cos(radians({lat})) * sin({a}) * cos(radians({h})))"
    return f"degrees({p2})", f"degrees(radians({lon}) + atan2(sin(radians({h})) * sin({a}) * cos(radians({lat})), cos({a}) - sin(radians({lat})) * sin({p2})))"


@query(
    "g07_rect_expand",
    over_views(
        f"SELECT path_index, seg_index, round({_sql_dest('y0', 'x1', '25e1', '18e1')[0]}, 7) AS south, round({_sql_dest('y1', 'x0', '25e1', '0e0')[0]}, 7) AS north, round({_sql_dest('y1', 'x0', '25e1', '27e1')[1]}, 7) AS west, round({_sql_dest('y0', 'x1', '25e1', '9e1')[1]}, 7) AS east FROM b",
        f"b AS (SELECT path_index, seg_index, {_BOX_SQL} FROM path_segments)",
    ),
)
def g07(spark: SparkSession, d: str) -> DataFrame:
    x0, x1, y0, y1 = geom.bounds(*_seg())
    sides = geo.expand(y0, y1, x0, x1, F.lit(250.0))
    return path_segments(spark).select("path_index", "seg_index", *(F.round(s, 7).alias(n) for s, n in zip(sides, ("south", "north", "west", "east"), strict=True)))


def _wide(lat: str) -> str:
    return sql_distance(lat, "x0", lat, "x1")


@query(
    "g08_area",
    over_views(
        f"SELECT path_index, round(h / 2 * (wl + wm) / 2 + h / 2 * (wm + wh) / 2, 2) AS m2, round(h, 4) AS height FROM (SELECT path_index, {sql_distance('y0', 'x0', 'y1', 'x0')} AS h, {_wide('y0')} AS wl, {_wide('((y0 + y1) / 2)')} AS wm, {_wide('y1')} AS wh FROM b)",
        "b AS (SELECT path_index, min(least(lon1, lon2)) AS x0, max(greatest(lon1, lon2)) AS x1, min(least(lat1, lat2)) - 1e-3 AS y0, max(greatest(lat1, lat2)) AS y1 FROM path_segments GROUP BY path_index)",
    ),
)
def g08(spark: SparkSession, d: str) -> DataFrame:
    b = path_segments(spark).groupBy("path_index").agg(F.min(F.least("lon1", "lon2")).alias("x0"), F.max(F.greatest("lon1", "lon2")).alias("x1"), (F.min(F.least("lat1", "lat2")) - 1e-3).alias("y0"), F.max(F.greatest("lat1", "lat2")).alias("y1"))
    return b.select("path_index", F.round(geo.bisected_area(c("y0"), c("y1"), c("x0"), c("x1"), 1), 2).alias("m2"), F.round(geo.distance(c("y0"), c("x0"), c("y1"), c("x0")), 4).alias("height"))


@query("g09_dms", over_views("SELECT event_id, printf('%d.%02d.%04.1f%s', CAST(floor(v) AS BIGINT), CAST(floor((v - floor(v)) * 60) AS BIGINT), ((v - floor(v)) * 60 - floor((v - floor(v)) * 60)) * 60, CASE WHEN lon < 0 THEN 'W' ELSE 'E' END) AS dms FROM (SELECT event_id, lon, abs(lon) AS v FROM vehicle_reports)"))
def g09(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("event_id", geo.dms(c("lon"), "W", "E").alias("dms"))


@query("g10_heading_direction", over_views("SELECT event_id, CASE WHEN heading BETWEEN 0 AND 360 THEN round(radians(CAST((450 - heading) % 360 AS DOUBLE)), 9) END AS direction FROM vehicle_reports"))
def g10(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("event_id", F.round(geo.to_direction(c("heading")), 9).alias("direction"))


@query("g11_local_xy", over_views("SELECT event_id, round(cos(radians(90 - h)) * m, 4) AS x, round(sin(radians(90 - h)) * m, 4) AS y FROM d", f"d AS (SELECT event_id, {sql_distance('422e-1', '-7105e-2', 'lat', 'lon')} AS m, {sql_heading('422e-1', '-7105e-2', 'lat', 'lon')} AS h FROM vehicle_reports)"))
def g11(spark: SparkSession, d: str) -> DataFrame:
    x, y = geo.to_local(c("lat"), c("lon"), F.lit(LAT0), F.lit(LON0))
    return vehicle_reports(spark, d).select("event_id", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query("g12_point_ops", over_views("SELECT path_index, seg_index, round(lon2 - lon1, 6) AS dx, round(lon1 * lon2 + lat1 * lat2, 4) AS dot, round(sqrt((lon2 - lon1) * (lon2 - lon1) + (lat2 - lat1) * (lat2 - lat1)), 6) AS distance, round(CASE WHEN lat2 >= lat1 THEN atan2(lat2 - lat1, lon2 - lon1) ELSE atan2(lat2 - lat1, lon2 - lon1) + 2 * pi() END, 6) AS direction FROM path_segments"))
def g12(spark: SparkSession, d: str) -> DataFrame:
    p, q = _seg()
    return path_segments(spark).select("path_index", "seg_index", F.round(q[0] - p[0], 6).alias("dx"), F.round(geom.dot(p, q), 4).alias("dot"), F.round(geom.length(p, q), 6).alias("distance"), F.round(geom.direction(p, q), 6).alias("direction"))


@query("g13_rect_ops", over_views(f"SELECT path_index, round(max(x1) - min(x0), 6) AS width, round(max(y1) - min(y0), 6) AS height, round((max(x1) - min(x0)) * (max(y1) - min(y0)), 9) AS area, round((max(x1) + min(x0)) / 2, 6) AS center_x FROM (SELECT path_index, {_BOX_SQL} FROM path_segments) GROUP BY path_index"))
def g13(spark: SparkSession, d: str) -> DataFrame:
    x0, x1, y0, y1 = geom.bounds(*_seg())
    b = path_segments(spark).groupBy("path_index").agg(F.min(x0).alias("x0"), F.max(x1).alias("x1"), F.min(y0).alias("y0"), F.max(y1).alias("y1"))
    w, h = c("x1") - c("x0"), c("y1") - c("y0")
    return b.select("path_index", *_round(width=w, height=h), F.round(w * h, 9).alias("area"), *_round(center_x=(c("x1") + c("x0")) / 2))


_LO, _HI = sql_clip("lon1", "lat1", "lon2", "lat2", "-7119e-2", "-7101e-2", "42101e-3", "42258e-3")


def _clip_rect() -> geom.Rect:
    return tuple(F.lit(v) for v in (-71.19, -71.01, 42.101, 42.258))



@query("g15_clip", over_views("SELECT path_index, seg_index, round(lon1 + lo * (lon2 - lon1), 6) AS cx1, round(lat1 + lo * (lat2 - lat1), 6) AS cy1, round(lon1 + hi * (lon2 - lon1), 6) AS cx2, round(lat1 + hi * (lat2 - lat1), 6) AS cy2 FROM k WHERE lo <= hi", f"k AS (SELECT *, {_LO} AS lo, {_HI} AS hi FROM path_segments)"))
def g15(spark: SparkSession, d: str) -> DataFrame:
    a, b, hit = geom.clip(*_seg(), _clip_rect())
    return path_segments(spark).filter(hit).select("path_index", "seg_index", *_round(cx1=a[0], cy1=a[1], cx2=b[0], cy2=b[1]))


_FOOT = "((lon - lon1) * (lon2 - lon1) + (lat - lat1) * (lat2 - lat1)) / ((lon2 - lon1) * (lon2 - lon1) + (lat2 - lat1) * (lat2 - lat1))"


@query(
    "g16_closest_point",
    over_views(
        "SELECT event_id, round(lon1 + tc * (lon2 - lon1), 6) AS x, round(lat1 + tc * (lat2 - lat1), 6) AS y, t >= 0 AND t <= 1 AS perpendicular FROM (SELECT *, least(1e0, greatest(0e0, t)) AS tc FROM m)",
        f"m AS (SELECT event_id, lon1, lat1, lon2, lat2, {_FOOT} AS t FROM vehicle_reports JOIN path_segments ON path_index = event_id % 40 AND seg_index = event_id % 9)",
    ),
)
def g16(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).withColumn("path_index", c("event_id") % 40).withColumn("seg_index", c("event_id") % 9).drop("route_tag")
    x, y, _, perpendicular = geom.closest(*_seg(), (c("lon"), c("lat")))
    return r.join(path_segments(spark), ["path_index", "seg_index"]).select("event_id", *_round(x=x, y=y), perpendicular.alias("perpendicular"))


@query("g18_angle_between", over_views("SELECT event_id, round(CASE WHEN a > pi() THEN 2 * pi() - a ELSE a END, 6) AS angle FROM (SELECT event_id, abs(radians(CAST((450 - heading) % 360 AS DOUBLE)) - radians(CAST((event_id * 7) % 360 AS DOUBLE))) AS a FROM vehicle_reports WHERE heading BETWEEN 0 AND 360)"))
def g18(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).filter(geo.heading_valid(c("heading")))
    return r.select("event_id", F.round(geom.angle_between(geo.to_direction(c("heading")), F.radians(((c("event_id") * 7) % 360).cast("double"))), 6).alias("angle"))


@query(
    "g19_intersection",
    over_views(
        "SELECT path_index, seg_index, round(lon1 + t * (lon2 - lon1), 5) AS x, round(lat1 + t * (lat2 - lat1), 5) AS y FROM (SELECT *, ((a1 - lon1) * (b2 - b1) - (b1 - lat1) * (a2 - a1)) / det AS t FROM n WHERE abs(det) > 1e-12)",
        "n AS (SELECT *, (lon2 - lon1) * (b2 - b1) - (lat2 - lat1) * (a2 - a1) AS det FROM (SELECT *, lead(lon1) OVER w AS a1, lead(lat1) OVER w AS b1, lead(lon2) OVER w AS a2, lead(lat2) OVER w AS b2 FROM path_segments WINDOW w AS (PARTITION BY path_index ORDER BY seg_index)) WHERE a1 IS NOT NULL)",
    ),
)
def g19(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("path_index").orderBy("seg_index")
    n = path_segments(spark).select("*", *(F.lead(k).over(w).alias(f"n_{k}") for k in ("lon1", "lat1", "lon2", "lat2"))).filter("n_lon1 IS NOT NULL")
    det = (c("lon2") - c("lon1")) * (c("n_lat2") - c("n_lat1")) - (c("lat2") - c("lat1")) * (c("n_lon2") - c("n_lon1"))
    x, y = geom.intersection(*_seg(), (c("n_lon1"), c("n_lat1")), (c("n_lon2"), c("n_lat2")))
    return n.filter(F.abs(det) > 1e-12).select("path_index", "seg_index", F.round(x, 5).alias("x"), F.round(y, 5).alias("y"))


@query("g21_affine", over_views("SELECT event_id, round(2 * ((lon + 7105e-2) * cos(pi() / 6) + (lat - 422e-1) * sin(pi() / 6)), 6) AS x, round(3 * (-(lon + 7105e-2) * sin(pi() / 6) + (lat - 422e-1) * cos(pi() / 6)), 6) AS y, round(lon, 7) AS back_x FROM vehicle_reports"))
def g21(spark: SparkSession, d: str) -> DataFrame:
    m = geom.Affine.translation(-LON0, -LAT0).then(geom.Affine.rotation(math.pi / 6)).then(geom.Affine.scale(2, 3))
    x, y = m((c("lon"), c("lat")))
    return vehicle_reports(spark, d).select("event_id", *_round(x=x, y=y), F.round(m.inverse()((x, y))[0], 7).alias("back_x"))


@query("g23_bucket", over_views("SELECT event_id, CAST(trunc((lat - 422e-1) / 3e-1 * 16) AS INT) AS bucket FROM vehicle_reports"))
def g23(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("event_id", geom.bucket(c("lat"), F.lit(42.2), F.lit(0.3), 16).alias("bucket"))


@query("g24_weights", over_views("SELECT event_id, round(1 - least(pi() / 2, abs(radians(CAST(heading AS DOUBLE)))) / (pi() / 2), 6) AS angle_weight, round(CASE WHEN m <= 0 THEN 1 ELSE least(1, 1 / m) END, 6) AS distance_weight FROM (SELECT event_id, heading, CAST(event_id % 50 AS DOUBLE) AS m FROM vehicle_reports)"))
def g24(spark: SparkSession, d: str) -> DataFrame:
    m = (c("event_id") % 50).cast("double")
    angle = 1 - F.least(F.lit(math.pi / 2), F.abs(F.radians(c("heading").cast("double")))) / (math.pi / 2)
    near = F.when(m <= 0, 1.0).otherwise(F.least(F.lit(1.0), 1 / F.nullif(m, F.lit(0.0))))
    return vehicle_reports(spark, d).select("event_id", *_round(angle_weight=angle, distance_weight=near))


@query("t01_unix_ms", over_views("SELECT event_id, strftime(make_timestamp(unix_ms * 1000), '%Y%m%d %H%M%S') AS date_time, round(unix_ms / 1e3, 3) AS seconds FROM vehicle_reports"))
def t01(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("event_id", when.stamp(c("unix_ms")).alias("date_time"), F.round(when.ms_to_seconds(c("unix_ms")), 3).alias("seconds"))


@query("t02_day_bounds", over_views("SELECT event_id, CAST(CAST(t AS DATE) AS VARCHAR) AS midnight, CAST(CAST(t AS DATE) + 1 AS VARCHAR) AS next_midnight, strftime(date_trunc('hour', t), '%Y-%m-%d %H:%M:%S') AS snapped FROM (SELECT event_id, make_timestamp(unix_ms * 1000) AS t FROM vehicle_reports)"))
def t02(spark: SparkSession, d: str) -> DataFrame:
    day = when.day(c("unix_ms"))
    return vehicle_reports(spark, d).select("event_id", day.cast("string").alias("midnight"), F.date_add(day, 1).cast("string").alias("next_midnight"), F.date_format(when.snapped_hour(c("unix_ms")), "yyyy-MM-dd HH:mm:ss").alias("snapped"))


# Later times by steps that hit midnights, full hours, minutes, seconds and fractions over ten days, and earlier ones.
_LATER = "CASE event_id % 5 WHEN 0 THEN (unix_ms // 86400000 + event_id % 9) * 86400000 WHEN 1 THEN (unix_ms // 3600000 + event_id % 200) * 3600000 WHEN 2 THEN (unix_ms // 60000 + event_id * 37 % 14400) * 60000 WHEN 3 THEN (unix_ms // 1000 + event_id * 7919 % 864000) * 1000 ELSE unix_ms + event_id * 104729 % 864000000 - 1000 END"


@query(
    "t03_human_time",
    over_views(
        """SELECT event_id, CASE WHEN later <= now THEN full_time WHEN days <= 0 THEN clock WHEN days = 1 THEN 'tomorrow at ' || clock WHEN days < 7 THEN dayname(later) || ' at ' || clock ELSE strftime(later, '%Y-%m-%d') || ' at ' || clock END AS human
        FROM (SELECT *, date_diff('day', CAST(now AS DATE), CAST(later AS DATE)) - CASE WHEN clock = 'midnight' THEN 1 ELSE 0 END AS days, strftime(later, '%Y-%m-%dT%H:%M:%S') || CASE WHEN frac <> '' THEN '.' || frac ELSE '' END || 'Z' AS full_time FROM w)""",
        f"u AS (SELECT event_id, make_timestamp(unix_ms * 1000) AS now, make_timestamp(({_LATER}) * 1000) AS later FROM vehicle_reports)",
        "v AS (SELECT *, rtrim(strftime(later, '%g'), '0') AS frac, lower(strftime(later, '%p')) AS half, strftime(later, '%-I') AS h, strftime(later, '%M') AS m, strftime(later, '%S') AS s FROM u)",
        "w AS (SELECT *, CASE WHEN frac <> '' THEN h || ':' || m || ':' || s || '.' || frac || half WHEN s <> '00' THEN h || ':' || m || ':' || s || half WHEN m <> '00' THEN h || ':' || m || half WHEN hour(later) = 0 THEN 'midnight' WHEN hour(later) = 12 THEN 'noon' ELSE h || half END AS clock FROM v)",
    ),
)
def t03(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).select("event_id", "unix_ms", F.expr(_LATER.replace("//", "DIV")).alias("later_ms"))
    return r.select("event_id", when.human(when.ms_to_utc(c("unix_ms")), when.ms_to_utc(c("later_ms"))).alias("human"))


@query("t04_convert_zone", over_views("SELECT event_id, strftime(timezone('America/New_York', timezone('UTC', make_timestamp(unix_ms * 1000))), '%Y%m%d %H%M%S') AS local_time FROM vehicle_reports"))
def t04(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("event_id", when.stamp(c("unix_ms"), "America/New_York").alias("local_time"))


@query("t05_name_to_time", over_views("SELECT event_id, strftime(make_timestamp(unix_ms * 1000), '%H%M%S.%g.xml') AS name, strftime(make_timestamp(unix_ms * 1000), '%Y-%m-%d') AS day_name FROM vehicle_reports"))
def t05(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(c("unix_ms").cast("string"), F.lit(".xml"))
    return vehicle_reports(spark, d).select("event_id", when.name_to_time(name).alias("name"), when.dashed_date(F.substring(when.stamp(c("unix_ms")), 1, 8)).alias("day_name"))


@query("t06_server_time", "SELECT o_orderkey, round((o_orderkey * 10 + o_orderkey * 10 + o_custkey % 900) / 2e0, 3) AS midpoint, round(o_orderkey * 10 + 5 - (o_orderkey * 10 + o_orderkey * 10 + o_custkey % 900) / 2e0, 3) AS clock_offset FROM orders")
def t06(spark: SparkSession, d: str) -> DataFrame:
    start = c("o_orderkey") * 10
    mid = when.midpoint(start, start + c("o_custkey") % 900)
    return table(spark, d, "orders").select("o_orderkey", F.round(mid, 3).alias("midpoint"), F.round(start + 5 - mid, 3).alias("clock_offset"))


@query("x01_root_offset", r"SELECT page_id, CAST(length(regexp_extract(html, '^(?s:\s+|<\?.*?\?>|<!--.*?-->|<![^-\[>][^>]*>)*')) AS INT) AS root_at FROM pages WHERE html IS NOT NULL")
def x01(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").filter("html IS NOT NULL").select("page_id", xml.root_offset(c("html")).alias("root_at"))


@query("x02_strip_comments", r"SELECT page_id, md5(regexp_replace(html, '(?s)[ \n]*<!--.*?-->[ \n]*', '', 'g')) AS stripped_md5, CAST(len(regexp_extract_all(html, '(?s)<!--.*?-->')) AS INT) AS n_comments FROM pages")
def x02(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(xml.strip_comments(c("html"))).alias("stripped_md5"), F.size(xml.comments(c("html"))).alias("n_comments"))


@query("x03_escape", "SELECT page_id, md5(replace(replace(replace(replace(replace(url || html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&#34;'), '''', '&#39;')) AS escaped_md5 FROM pages")
def x03(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(xml.escape(F.concat("url", "html"))).alias("escaped_md5"))


@query("g14_segment_ops", over_views("SELECT path_index, seg_index, round(sqrt(power(lon2 - lon1, 2) + power(lat2 - lat1, 2)), 7) AS length, round(least(lat1, lat2), 6) AS y0, lon1 >= -712e-1 AND lon2 <= -71e0 AND least(lat1, lat2) >= 421e-1 AND greatest(lat1, lat2) <= 423e-1 AS in_rect FROM path_segments"))
def g14(spark: SparkSession, d: str) -> DataFrame:
    p, q = _seg()
    both = geom.inside(p, _rect()) & geom.inside(q, _rect())
    return path_segments(spark).select("path_index", "seg_index", F.round(geom.length(p, q), 7).alias("length"), F.round(geom.bounds(p, q)[2], 6).alias("y0"), both.alias("in_rect"))


@query("g20_ray", over_views("SELECT event_id, round(lon + cos(radians(CAST(90 - heading AS DOUBLE))), 6) AS x, round(lat + sin(radians(CAST(90 - heading AS DOUBLE))), 6) AS y FROM vehicle_reports WHERE heading BETWEEN 0 AND 360"))
def g20(spark: SparkSession, d: str) -> DataFrame:
    toward = geo.to_direction(c("heading"))
    return vehicle_reports(spark, d).filter(geo.heading_valid(c("heading"))).select("event_id", *_round(x=c("lon") + F.cos(toward), y=c("lat") + F.sin(toward)))
