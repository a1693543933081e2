"""Queries of the spatial joins, lookups and set-like joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, geom
from ..operators import diff, partition, spatial
from .fixtures import directions, over_views, path_segments, table, vehicle_reports
from .core import query
from .scalar_queries import sql_clip, sql_distance, sql_heading

c = F.col
#: Tolerances of map matching, in degrees of longitude and latitude, and how much a second search widens them.
DX, DY, WIDEN = 0.00067, 0.00042, 16.0


def _p() -> geom.Point:
    return c("lon1"), c("lat1")


def _q() -> geom.Point:
    return c("lon2"), c("lat2")


def _at() -> geom.Point:
    return c("lon"), c("lat")

#: Degrees within which a segment counts as near a report.
REACH = 0.004

_FOOT = "((lon - lon1) * (lon2 - lon1) + (lat - lat1) * (lat2 - lat1)) / ((lon2 - lon1) * (lon2 - lon1) + (lat2 - lat1) * (lat2 - lat1))"
_NEAR = f"""d0 AS (SELECT r.event_id, r.unix_ms, r.vehicle_id, r.route_tag AS report_route, r.dir_tag, r.heading, r.lon, r.lat, s.path_index, s.seg_index, s.lon1, s.lat1, s.lon2, s.lat2, {_FOOT} AS t
    FROM vehicle_reports r JOIN path_segments s ON s.lon1 < r.lon + 5e-3 AND s.lon2 > r.lon - 5e-3 AND least(s.lat1, s.lat2) < r.lat + 5e-3 AND greatest(s.lat1, s.lat2) > r.lat - 5e-3),
d1 AS (SELECT *, least(1e0, greatest(0e0, t)) AS tc FROM d0),
d2 AS (SELECT *, sqrt(power(lon - lon1 - tc * (lon2 - lon1), 2) + power(lat - lat1 - tc * (lat2 - lat1), 2)) AS distance,
    CASE WHEN heading BETWEEN 0 AND 360 THEN abs(radians(CAST((450 - heading) % 360 AS DOUBLE)) - (CASE WHEN lat2 >= lat1 THEN atan2(lat2 - lat1, lon2 - lon1) ELSE atan2(lat2 - lat1, lon2 - lon1) + 2 * pi() END)) END AS a0 FROM d1),
near AS (SELECT *, CASE WHEN a0 > pi() THEN 2 * pi() - a0 ELSE a0 END AS angle, t >= 0 AND t <= 1 AS perpendicular FROM d2 WHERE distance <= 4e-3)"""


def report_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of a report and a segment within REACH, with distance, angle and whether the perpendicular meets the segment."""
    r = vehicle_reports(spark, d).withColumnRenamed("route_tag", "report_route")
    _, _, away, perpendicular = geom.closest(_p(), _q(), _at())
    pairs = spatial.range_join(r, path_segments(spark), spatial.box_around(*_at(), REACH, REACH), geom.bounds(_p(), _q()), 2 * REACH, away <= REACH)
    angle = geom.angle_between(geo.to_direction(c("heading")), geom.direction(_p(), _q()))
    return pairs.withColumns({"distance": away, "perpendicular": perpendicular, "angle": angle})


def matches(spark: SparkSession, d: str) -> DataFrame:
    return spatial.tolerant_match(vehicle_reports(spark, d), path_segments(spark), directions(spark), DX, DY, WIDEN)


_RECTS = "rects AS (SELECT range AS rect_id, -712e-1 + (range % 6) * 3e-2 AS rx0, -712e-1 + (range % 6) * 3e-2 + 4e-2 AS rx1, 4205e-2 + (range // 6) * 7e-2 AS ry0, 4205e-2 + (range // 6) * 7e-2 + 5e-2 AS ry1 FROM range(24))"
_RL, _RH = sql_clip("lon1", "lat1", "lon2", "lat2", "rx0", "rx1", "ry0", "ry1")


@query("j01_spatial_range", over_views(f"SELECT rect_id, path_index, seg_index FROM rects JOIN path_segments ON least(lon1, lon2) < rx1 AND rx0 < greatest(lon1, lon2) AND least(lat1, lat2) < ry1 AND ry0 < greatest(lat1, lat2) AND {_RL} <= {_RH}", _RECTS))
def j01(spark: SparkSession, d: str) -> DataFrame:
    rects = spark.range(24).selectExpr("id AS rect_id", "-712e-1 + (id % 6) * 3e-2 AS rx0", "-712e-1 + (id % 6) * 3e-2 + 4e-2 AS rx1", "4205e-2 + (id DIV 6) * 7e-2 AS ry0", "4205e-2 + (id DIV 6) * 7e-2 + 5e-2 AS ry1")
    box = tuple(c(k) for k in ("rx0", "rx1", "ry0", "ry1"))
    pairs = spatial.range_join(rects, path_segments(spark), box, geom.bounds(_p(), _q()), 0.05, geom.clip_interval(_p(), _q(), box)[2])
    return pairs.select("rect_id", "path_index", "seg_index")


@query("j03_nearest_segment", over_views("SELECT event_id, path_index, seg_index, round(distance, 7) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY distance, path_index, seg_index) AS k FROM near) WHERE k = 1", _NEAR))
def j03(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).select("event_id", "lon", "lat")
    best = spatial.nearest_join(r, path_segments(spark), _at(), (_p(), _q()), ["event_id"], ["path_index", "seg_index"], REACH)
    return best.select("event_id", "path_index", "seg_index", F.round("distance", 7).alias("distance"))


_TIGHT = list(sql_clip("lon1", "lat1", "lon2", "lat2", "lon - 67e-5", "lon + 67e-5", "lat - 42e-5", "lat + 42e-5"))
_BOX = "least(lon1, lon2) < lon + {0} AND lon - {0} < greatest(lon1, lon2) AND least(lat1, lat2) < lat + {1} AND lat - {1} < greatest(lat1, lat2)"


@query("j05_nearby_paths", over_views(f"SELECT DISTINCT r.event_id, s.path_index FROM vehicle_reports r JOIN path_segments s ON {_BOX.format('67e-5', '42e-5')} AND {_TIGHT[0]} <= {_TIGHT[1]}"))
def j05(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).select("event_id", "lon", "lat")
    box = spatial.box_around(*_at(), DX, DY)
    pairs = spatial.range_join(r, path_segments(spark), box, geom.bounds(_p(), _q()), 0.004, geom.clip_interval(_p(), _q(), box)[2])
    return pairs.select("event_id", "path_index").distinct()


_WLO, _WHI = sql_clip("lon1", "lat1", "lon2", "lat2", "lon - 1072e-5", "lon + 1072e-5", "lat - 672e-5", "lat + 672e-5")
_MATCH = f"""asked AS (SELECT event_id, lon, lat, 0 AS side, route_tag FROM vehicle_reports
    UNION ALL SELECT event_id, lon, lat, 1, g.route_tag FROM vehicle_reports r JOIN directions g ON r.dir_tag = g.dir_tag AND r.route_tag <> g.route_tag),
pairs AS (SELECT event_id, side, path_index, bool_or({_BOX.format('67e-5', '42e-5')} AND {_TIGHT[0]} <= {_TIGHT[1]}) AS tight
    FROM asked a JOIN path_segments s ON a.route_tag = s.route_tag AND {_BOX.format('1072e-5', '672e-5')} AND {_WLO} <= {_WHI} GROUP BY ALL),
match AS (SELECT DISTINCT event_id, path_index FROM (SELECT *, bool_or(tight) OVER (PARTITION BY event_id, side) AS any_tight FROM pairs) WHERE tight OR NOT any_tight)"""


@query("j06_tolerant_match", over_views("SELECT event_id, path_index FROM match", _MATCH))
def j06(spark: SparkSession, d: str) -> DataFrame:
    return matches(spark, d)


@query(
    "j07_match_fanout",
    over_views("SELECT coalesce(path_index, -1) AS path_index, dir_tag, count(*) AS reports, round(avg(lat), 6) AS mean_lat, round(avg(lon), 6) AS mean_lon FROM vehicle_reports r LEFT JOIN match m ON r.event_id = m.event_id GROUP BY ALL", _MATCH),
)
def j07(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).join(matches(spark, d), "event_id", "left")
    return r.groupBy(F.coalesce("path_index", F.lit(-1)).alias("path_index"), "dir_tag").agg(F.count("*").alias("reports"), F.round(F.avg("lat"), 6).alias("mean_lat"), F.round(F.avg("lon"), 6).alias("mean_lon"))


@query("j08_link_edges", over_views("SELECT event_id, path_index, seg_index, round(distance, 7) AS distance, perpendicular, round(angle, 6) AS angle FROM near", _NEAR))
def j08(spark: SparkSession, d: str) -> DataFrame:
    return report_segments(spark, d).select("event_id", "path_index", "seg_index", F.round("distance", 7).alias("distance"), "perpendicular", F.round("angle", 6).alias("angle"))


@query("j09_nearest_perpendicular", over_views("SELECT event_id, path_index, seg_index FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY distance, path_index, seg_index) AS k FROM near WHERE perpendicular) WHERE k = 1", _NEAR))
def j09(spark: SparkSession, d: str) -> DataFrame:
    near = report_segments(spark, d).filter("perpendicular")
    best = near.groupBy("event_id").agg(F.min_by(F.struct("path_index", "seg_index"), F.struct("distance", "path_index", "seg_index")).alias("s"))
    return best.select("event_id", "s.*")


@query("j10_lookup", over_views("SELECT r.dir_tag, g.route_tag, count(*) AS reports FROM vehicle_reports r LEFT JOIN directions g ON r.dir_tag = g.dir_tag GROUP BY ALL"))
def j10(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).select("dir_tag").join(directions(spark), "dir_tag", "left").groupBy("dir_tag", "route_tag").agg(F.count("*").alias("reports"))


# Two listings of all documents by id and text, the second with every id moved and the texts in small letters.
_SIDES = "a AS (SELECT doc_id, md5(text) AS content FROM documents), b AS (SELECT doc_id + 13 AS doc_id, md5(lower(text)) AS content FROM documents)"


def _directories(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.md5("text").alias("content")), docs.select((c("doc_id") + 13).alias("doc_id"), F.md5(F.lower("text")).alias("content"))


@query("j11_full_outer", f"WITH {_SIDES} SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'only1' WHEN a.doc_id IS NULL THEN 'only2' ELSE 'common' END AS place FROM a FULL JOIN b ON a.doc_id = b.doc_id")
def j11(spark: SparkSession, d: str) -> DataFrame:
    return diff.partition_entries(*_directories(spark, d), "doc_id").select("doc_id", "place")


@query("e01_set_ops", f"WITH {_SIDES} SELECT 'both' AS op, count(*) AS n FROM (SELECT content FROM a INTERSECT SELECT content FROM b) UNION ALL SELECT 'left', count(*) FROM (SELECT content FROM a EXCEPT SELECT content FROM b) UNION ALL SELECT 'right', count(*) FROM (SELECT content FROM b EXCEPT SELECT content FROM a)")
def e01(spark: SparkSession, d: str) -> DataFrame:
    a, b = (x.select("content") for x in _directories(spark, d))
    count = lambda x, op: x.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n")
    return count(a.intersect(b), "both").union(count(a.subtract(b), "left")).union(count(b.subtract(a), "right"))


# Each source as one snapshot of a directory, with its documents as files; and the catalogue of customers, one snapshot for each segment and one file for each nation.
_FILES = """f AS (SELECT source AS d, CAST(doc_id AS VARCHAR) AS k, md5(text) AS content FROM documents
    UNION ALL SELECT 'segment ' || c_mktsegment, CAST(c_nationkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM customer GROUP BY ALL)"""


@query(
    "e02_dir_verdict",
    f"""WITH {_FILES}, p AS (SELECT lag(d) OVER (ORDER BY d) AS s1, d AS s2 FROM (SELECT DISTINCT d FROM f)),
    x AS (SELECT s1, s2, k, max(content) FILTER (side = 1) AS c1, max(content) FILTER (side = 2) AS c2 FROM (
        SELECT s1, s2, k, content, 1 AS side FROM p JOIN f ON f.d = p.s1 UNION ALL SELECT s1, s2, k, content, 2 FROM p JOIN f ON f.d = p.s2 WHERE s1 IS NOT NULL) GROUP BY ALL)
    SELECT s1, s2, CASE WHEN differing > 0 OR only1 > 0 AND only2 > 0 THEN 'different' WHEN only1 > 0 THEN 'first_more_complete' WHEN only2 > 0 THEN 'second_more_complete' ELSE 'equivalent' END AS verdict
    FROM (SELECT s1, s2, count(*) FILTER (c1 <> c2) AS differing, count(*) FILTER (c2 IS NULL) AS only1, count(*) FILTER (c1 IS NULL) AS only2 FROM x GROUP BY ALL)""",
)
def e02(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(c("source").alias("d"), c("doc_id").cast("string").alias("k"), F.md5("text").alias("content"))
    nations = table(spark, d, "customer").groupBy(F.concat(F.lit("segment "), "c_mktsegment").alias("d"), c("c_nationkey").cast("string").alias("k")).agg(F.count("*").cast("string").alias("content"))
    return diff.directory_verdicts(docs.union(nations), "d", "k", "content").select(c("first").alias("s1"), c("second").alias("s2"), "verdict")


@query("e05_union_matches", over_views("SELECT count(*) AS n, count(DISTINCT event_id) AS reports FROM (SELECT event_id, path_index FROM match UNION SELECT event_id, path_index FROM near)", _MATCH, _NEAR))
def e05(spark: SparkSession, d: str) -> DataFrame:
    both = matches(spark, d).select("event_id", "path_index").union(report_segments(spark, d).select("event_id", "path_index")).distinct()
    return both.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("reports"))


# Leaves of a fixed grid: cuts on the two axes, the outer ones open.
_CUTS_X, _CUTS_Y = (-71.15, -71.1, -71.05), (42.15, 42.2, 42.25, 42.3)
_LEAF = "CASE " + " ".join(f"WHEN lat < {y}e0 THEN {i}" for i, y in enumerate(_CUTS_Y)) + f" ELSE {len(_CUTS_Y)} END * {len(_CUTS_X) + 1} + CASE " + " ".join(f"WHEN lon < {x}e0 THEN {i}" for i, x in enumerate(_CUTS_X)) + f" ELSE {len(_CUTS_X)} END"


def routed(spark: SparkSession, d: str) -> DataFrame:
    leaves = partition.grid_leaves(spark, list(_CUTS_X), list(_CUTS_Y))
    return partition.route(vehicle_reports(spark, d), leaves, c("lon"), c("lat"))


@query("j12_route_to_leaf", over_views(f"SELECT event_id, CAST({_LEAF} AS BIGINT) AS leaf FROM vehicle_reports"))
def j12(spark: SparkSession, d: str) -> DataFrame:
    return routed(spark, d).select("event_id", c("leaf").cast("long").alias("leaf"))


@query("r06_leaf_counts", over_views(f"SELECT CAST({_LEAF} AS BIGINT) AS leaf, count(*) AS reports FROM vehicle_reports GROUP BY ALL"))
def r06(spark: SparkSession, d: str) -> DataFrame:
    return routed(spark, d).groupBy(c("leaf").cast("long").alias("leaf")).agg(F.count("*").alias("reports"))


@query("r07_pruned_scan", over_views(f"SELECT event_id FROM vehicle_reports WHERE {_LEAF} IN (0, 1, 4, 5)"))
def r07(spark: SparkSession, d: str) -> DataFrame:
    leaves = partition.grid_leaves(spark, list(_CUTS_X), list(_CUTS_Y))
    wanted = partition.overlapping(leaves, (-71.19, -71.12, 42.11, 42.17))
    return partition.route(vehicle_reports(spark, d), leaves, c("lon"), c("lat")).filter(c("leaf").isin(wanted)).select("event_id")


@query("p13_unknown_dir", over_views("SELECT event_id FROM vehicle_reports r WHERE NOT EXISTS (SELECT 1 FROM directions g WHERE g.dir_tag = r.dir_tag AND g.route_tag <> '3')"))
def p13(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).join(directions(spark).filter("route_tag <> '3'"), "dir_tag", "left_anti").select("event_id")


@query("j13_semi", over_views("SELECT count(*) AS n FROM vehicle_reports WHERE dir_tag IN (SELECT dir_tag FROM directions WHERE route_tag IN ('1', '2'))"))
def j13(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).join(directions(spark).filter("route_tag IN ('1', '2')"), "dir_tag", "left_semi").agg(F.count("*").alias("n"))


@query("s25_pending_archives", "SELECT day FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events) WHERE day NOT IN (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) FROM events WHERE user_id < 3 AND value > 80) AND day < (SELECT max(CAST(CAST(ts AS DATE) AS VARCHAR)) FROM events)")
def s25(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.to_date("ts").cast("string").alias("day"), "user_id", "value")
    return diff.pending(e.select("day").distinct(), e.filter("user_id < 3 AND value > 80").select("day"), "day")


@query("g17_segments", over_views("SELECT path_index, seg_index, round(len, 6) AS length, round(coalesce(sum(len) OVER (PARTITION BY path_index ORDER BY seg_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS start_offset FROM (SELECT *, sqrt(power(lon2 - lon1, 2) + power(lat2 - lat1, 2)) AS len FROM path_segments)"))
def g17(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark).select("path_index", "seg_index", F.round("length", 6).alias("length"), F.round("start_offset", 6).alias("start_offset"))


def waypoints(spark: SparkSession) -> DataFrame:
    s = path_segments(spark)
    last = s.filter("seg_index = 8").select("path_index", F.lit(9).cast("long").alias("position"), c("lon2").alias("x"), c("lat2").alias("y"))
    return s.select("path_index", c("seg_index").alias("position"), c("lon1").alias("x"), c("lat1").alias("y")).union(last)


def segments(spark: SparkSession) -> DataFrame:
    return spatial.directed_segments(waypoints(spark))


@query(
    "g22_resegment",
    over_views(
        """SELECT m.path_index, m.k AS position, round(lon1 + t * (lon2 - lon1), 5) AS x, round(lat1 + t * (lat2 - lat1), 5) AS y FROM (
        SELECT q.path_index, q.k, s.lon1, s.lat1, s.lon2, s.lat2, least(1e0, greatest(0e0, (q.k * q.piece - s.o) / s.len)) AS t, row_number() OVER (PARTITION BY q.path_index, q.k ORDER BY s.seg_index DESC) AS n
        FROM (SELECT *, unnest(range(0, CAST(pieces AS BIGINT) + 1)) AS k FROM tot) q JOIN s ON s.path_index = q.path_index AND (s.o <= q.k * q.piece OR s.seg_index = 0)) m WHERE n = 1""",
        "s AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY path_index ORDER BY seg_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM (SELECT *, sqrt(power(lon2 - lon1, 2) + power(lat2 - lat1, 2)) AS len FROM path_segments))",
        "tot AS (SELECT path_index, ceil(sum(len) / 13e-3) AS pieces, sum(len) / ceil(sum(len) / 13e-3) AS piece FROM s GROUP BY path_index HAVING ceil(sum(len) / 13e-3) >= 2)",
    ),
)
def g22(spark: SparkSession, d: str) -> DataFrame:
    return spatial.resegment(segments(spark), 0.013).select("path_index", "position", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


@query("m06_planar_reports", over_views("SELECT event_id, round(cos(radians(90 - h)) * m, 4) AS x, round(sin(radians(90 - h)) * m, 4) AS y, CASE WHEN heading BETWEEN 0 AND 360 THEN round(radians(CAST((450 - heading) % 360 AS DOUBLE)), 9) END AS direction FROM d", f"d AS (SELECT event_id, heading, {sql_distance('422e-1', '-7105e-2', 'lat', 'lon')} AS m, {sql_heading('422e-1', '-7105e-2', 'lat', 'lon')} AS h FROM vehicle_reports)"))
def m06(spark: SparkSession, d: str) -> DataFrame:
    x, y = geo.to_local(c("lat"), c("lon"), F.lit(42.2), F.lit(-71.05))
    return vehicle_reports(spark, d).select("event_id", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"), F.round(geo.to_direction(c("heading")), 9).alias("direction"))


@query("k08_fanout_keys", over_views("SELECT coalesce(path_index, -1) AS path_index, count(*) AS reports FROM vehicle_reports r LEFT JOIN match m ON r.event_id = m.event_id GROUP BY ALL", _MATCH))
def k08(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).select("event_id").join(matches(spark, d), "event_id", "left")
    return r.groupBy(F.coalesce("path_index", F.lit(-1)).alias("path_index")).agg(F.count("*").alias("reports"))


def planner_sample(spark: SparkSession, d: str) -> DataFrame:
    """Sixteen places about each report, as a planner needs more rows than the smallest table has."""
    r = vehicle_reports(spark, d).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(15))))
    return r.select((c("lon") + (c("k") * 7 % 16 - 8) * 1e-4).alias("lon"), (c("lat") + (c("k") - 8) * 1e-4).alias("lat"))


def _planned(spark: SparkSession, d: str, leaves: DataFrame) -> DataFrame:
    """leaf, reports: how a plan deals out all reports."""
    return partition.route(vehicle_reports(spark, d), leaves, c("lon"), c("lat")).groupBy("leaf").agg(F.count("*").alias("reports"))


@query("r01_equal_count_plan")
def r01(spark: SparkSession, d: str) -> DataFrame:
    return _planned(spark, d, partition.equal_count_leaves(spark, planner_sample(spark, d), "lon", "lat", 2, 5))


@query("r03_root_sizes")
def r03(spark: SparkSession, d: str) -> DataFrame:
    rows = [(i, *partition.root_sizes(float(sn), float(we), float(least))) for i, sn, we, least in ((1, 3300, 5500, 48), (2, 2000, 2000, 30), (3, 4100, 900, 48))]
    return spark.createDataFrame(rows, "region int, sn int, we int, unit int")


@query("r04_square_plan")
def r04(spark: SparkSession, d: str) -> DataFrame:
    return _planned(spark, d, partition.square_leaves(spark, planner_sample(spark, d), "lon", "lat"))


_EDGES = "SELECT *, lag(cut) OVER (ORDER BY cut) AS lo FROM (SELECT unnest([{}, CAST('Infinity' AS DOUBLE)]) AS cut)"
_GRID = f"""xs AS (SELECT row_number() OVER (ORDER BY cut) - 1 AS i, coalesce(lo, CAST('-Infinity' AS DOUBLE)) AS x0, cut AS x1 FROM ({_EDGES.format(", ".join(f"{v}e0" for v in _CUTS_X))})),
ys AS (SELECT row_number() OVER (ORDER BY cut) - 1 AS j, coalesce(lo, CAST('-Infinity' AS DOUBLE)) AS y0, cut AS y1 FROM ({_EDGES.format(", ".join(f"{v}e0" for v in _CUTS_Y))}))"""


@query("k10_leaf_json", f"WITH {_GRID} SELECT CAST(j * {len(_CUTS_X) + 1} + i AS INT) AS leaf, isinf(x0) AS open_west, isinf(x1) AS open_east, CASE WHEN NOT isinf(x0) THEN x0 END AS x0, CASE WHEN NOT isinf(x1) THEN x1 END AS x1, CASE WHEN NOT isinf(y0) THEN y0 END AS y0, CASE WHEN NOT isinf(y1) THEN y1 END AS y1 FROM xs, ys")
def k10(spark: SparkSession, d: str) -> DataFrame:
    leaves = partition.grid_leaves(spark, list(_CUTS_X), list(_CUTS_Y)).select(F.to_json(F.struct("leaf", *(c(k).cast("string").alias(k) for k in ("x0", "x1", "y0", "y1")))).alias("j"))
    back = leaves.select(F.from_json("j", "leaf int, x0 string, x1 string, y0 string, y1 string").alias("b")).select("b.*")
    value = {k: c(k).cast("double") for k in ("x0", "x1", "y0", "y1")}
    open_ = lambda k: F.abs(value[k]) == float("inf")
    return back.select("leaf", open_("x0").alias("open_west"), open_("x1").alias("open_east"), *(F.when(~open_(k), value[k]).alias(k) for k in value))
