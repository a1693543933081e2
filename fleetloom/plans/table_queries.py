"""Queries of sources, sinks, sorts, diffs and merging over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import when
from ..operators import diff, merge, order, release
from ..sources import csv_rows
from .fixtures import over_views, table, vehicle_reports
from .core import query

c = F.col
_CSV = "raw AS (SELECT event_id, CASE WHEN event_id % 31 = 0 THEN 'x' ELSE CAST(unix_ms AS VARCHAR) END AS f0, vehicle_id, route_tag, dir_tag, CASE WHEN event_id % 17 = 0 THEN '400' ELSE CAST(heading AS VARCHAR) END AS f5, CASE WHEN event_id % 29 = 0 THEN '95.5' ELSE '42.25' END AS f6 FROM vehicle_reports)"


@query("s04_parse_validate", over_views("SELECT event_id, CASE WHEN ok THEN TRY_CAST(f0 AS BIGINT) END AS unix_ms, CASE WHEN ok THEN CASE WHEN CAST(f5 AS INT) BETWEEN -2 AND 360 THEN CAST(f5 AS INT) ELSE -1 END END AS heading, NOT ok AS rejected FROM (SELECT *, coalesce(TRY_CAST(f0 AS BIGINT) >= 946684800000 AND TRY_CAST(f0 AS BIGINT) <= 4102444800000, false) AND CAST(f6 AS DOUBLE) BETWEEN -90 AND 90 AS ok FROM raw)", _CSV))
def s04(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d)
    raw = r.select(
        "event_id", F.when(c("event_id") % 31 == 0, "x").otherwise(c("unix_ms").cast("string")).alias("unix_ms"), F.lit("").alias("date_time"), "vehicle_id", "route_tag", "dir_tag",
        F.when(c("event_id") % 17 == 0, "400").otherwise(c("heading").cast("string")).alias("heading"), F.when(c("event_id") % 29 == 0, "95.5").otherwise("42.25").alias("latitude"), F.lit("-71.5").alias("longitude"),
    )
    done = csv_rows.parse(raw, latest_ms=4102444800000, keep=["event_id"])
    return done.select("event_id", "unix_ms", "heading", c("error").isNotNull().alias("rejected"))


@query("s09_newest_rows", "SELECT event_id FROM events WHERE CAST(ts AS DATE) IN (SELECT day FROM (SELECT day, sum(n) OVER (ORDER BY day DESC) - n AS before FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)) WHERE before < 500)")
def s09(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", "ts", F.to_date("ts").alias("file"))
    return csv_rows.newest_files(rows, "file", "ts", 500).select("event_id")


@query("k05_skip_done_days", over_views("SELECT event_id FROM vehicle_reports WHERE CAST(make_timestamp((unix_ms - 1) * 1000) AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) + CAST(date_diff('day', (SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT min(CAST(ts AS DATE)) FROM events)) AS INT) FROM orders WHERE o_totalprice > 400000)"))
def k05(spark: SparkSession, d: str) -> DataFrame:
    orders, first = table(spark, d, "orders"), table(spark, d, "events").agg(F.min(F.to_date("ts")).alias("a"))
    shift = orders.agg(F.min(F.to_date("o_orderdate")).alias("b")).crossJoin(first)  # one row each
    done = orders.filter("o_totalprice > 400000").crossJoin(F.broadcast(shift)).select(F.date_add(F.to_date("o_orderdate"), F.date_diff("a", "b")).alias("day"))
    return csv_rows.skip_done(vehicle_reports(spark, d), when.archive_day(c("unix_ms")), done).select("event_id")


@query("s14_report_time", over_views("SELECT batch, CAST(max(unix_ms) // 1000 * 1000 + min(age) * 1000 AS BIGINT) AS report_ms, min(age) AS min_age, count(*) AS vehicles FROM (SELECT event_id // 10 AS batch, unix_ms, CAST(event_id * 7 % 60 AS INT) AS age FROM vehicle_reports) GROUP BY batch"))
def s14(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.feed_xml import report_time

    r = vehicle_reports(spark, d).select(F.expr("event_id DIV 10").alias("batch"), "unix_ms", (c("event_id") * 7 % 60).cast("int").alias("age"))
    bodies = r.groupBy("batch").agg((F.expr("max(unix_ms) DIV 1000") * 1000).alias("last_ms"), F.collect_list("age").alias("ages"))
    return bodies.select("batch", report_time(c("last_ms"), c("ages")).alias("report_ms"), F.array_min("ages").alias("min_age"), F.size("ages").cast("long").alias("vehicles"))


@query("k01_csv_fields", over_views("SELECT event_id, concat_ws(',', unix_ms, strftime(make_timestamp(unix_ms * 1000), '%Y%m%d %H%M%S'), vehicle_id, route_tag, dir_tag, heading) AS line FROM vehicle_reports"))
def k01(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d)
    return r.select("event_id", F.concat_ws(",", c("unix_ms").cast("string"), when.stamp(c("unix_ms")), "vehicle_id", "route_tag", "dir_tag", c("heading").cast("string")).alias("line"))


@query("k03_daily_rollup", over_views("SELECT CAST(CAST(make_timestamp((unix_ms - 1) * 1000) AS DATE) AS VARCHAR) AS day, count(*) AS reports, count(DISTINCT vehicle_id) AS vehicles, min(unix_ms) AS first_ms, max(unix_ms) AS last_ms FROM vehicle_reports GROUP BY ALL"))
def k03(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).withColumn("day", when.archive_day(c("unix_ms")).cast("string"))
    return r.groupBy("day").agg(F.count("*").alias("reports"), F.count_distinct("vehicle_id").alias("vehicles"), F.min("unix_ms").alias("first_ms"), F.max("unix_ms").alias("last_ms"))


@query("k04_two_minute", over_views("SELECT unix_ms // 120000 * 120000 AS slot_ms, count(*) AS reports FROM vehicle_reports GROUP BY ALL"))
def k04(spark: SparkSession, d: str) -> DataFrame:
    w = F.window(F.timestamp_millis(c("unix_ms")), "2 minutes")
    return vehicle_reports(spark, d).groupBy(F.unix_millis(w["start"]).alias("slot_ms")).agg(F.count("*").alias("reports"))


@query("o02_sorted", over_views("SELECT event_id, row_number() OVER (PARTITION BY vehicle_id ORDER BY unix_ms, event_id) AS place FROM vehicle_reports"))
def o02(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("vehicle_id").orderBy("unix_ms", "event_id")
    return vehicle_reports(spark, d).select("event_id", F.row_number().over(w).cast("long").alias("place"))


@query("o03_south_north", over_views("SELECT event_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM vehicle_reports ORDER BY lat, lon, event_id"))
def o03(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).orderBy("lat", "lon", "event_id").select("event_id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


# Reports come up to a minute late; the buffer holds all reports of far more than a minute, so its order is the full one.
@query("o05_bounded_disorder", over_views("SELECT event_id, row_number() OVER (PARTITION BY unix_ms // 86400000 ORDER BY unix_ms, event_id) AS place FROM vehicle_reports"))
def o05(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).select("event_id", "unix_ms", F.expr("unix_ms DIV 86400000").alias("day"), (c("unix_ms") + c("event_id") * 7919 % 60000).alias("arrival"))
    return order.bounded_sort(r, ["day"], ["arrival", "event_id"], ["unix_ms", "event_id"]).select("event_id", "place")


@query("o06_topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def o06(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


@query("p12_catalogue_consistency", over_views("SELECT vehicle_id, min(route_tag) AS route_tag, count(DISTINCT route_tag) > 1 AS mismatch FROM vehicle_reports GROUP BY ALL"))
def p12(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).groupBy("vehicle_id").agg(F.min("route_tag").alias("route_tag"), (F.count_distinct("route_tag") > 1).alias("mismatch"))


@query("w06_cull_runs", "SELECT doc_id, NOT (coalesce(k = lag(k) OVER w, false) AND coalesce(k = lead(k) OVER w, false)) AS kept FROM (SELECT doc_id, source, md5(lang) AS k FROM documents) WINDOW w AS (PARTITION BY source ORDER BY doc_id)")
def w06(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", F.md5("lang").alias("k"))
    return diff.cull_runs(docs, ["source"], "doc_id", "k").select("doc_id", F.coalesce("kept", F.lit(True)).alias("kept"))


@query(
    "e04_struct_diff",
    "SELECT a.doc_id AS id, f AS path, 'value' AS kind, CASE f WHEN 'source' THEN a.source WHEN 'lang' THEN a.lang ELSE CAST(a.n_chars AS VARCHAR) END AS v1, CASE f WHEN 'source' THEN b.source WHEN 'lang' THEN b.lang ELSE CAST(b.n_chars AS VARCHAR) END AS v2 FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 20 CROSS JOIN (VALUES ('source'), ('lang'), ('n_chars')) t(f) WHERE CASE f WHEN 'source' THEN a.source WHEN 'lang' THEN a.lang ELSE CAST(a.n_chars AS VARCHAR) END IS DISTINCT FROM CASE f WHEN 'source' THEN b.source WHEN 'lang' THEN b.lang ELSE CAST(b.n_chars AS VARCHAR) END",
)
def e04(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(c("doc_id").alias("id"), "source", "lang", "n_chars")
    later = docs.withColumn("id", c("id") - 20)
    both = later.select("id").join(docs.select("id"), "id")
    return diff.deep_diff(docs.join(both, "id"), later.join(both, "id"), "id")


@query("z07_latest", over_views("SELECT vehicle_id, event_id, unix_ms, dir_tag FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY unix_ms DESC, event_id DESC) AS k FROM vehicle_reports) WHERE k = 1"))
def z07(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).select("vehicle_id", "event_id", "unix_ms", "dir_tag")
    return merge.latest(r, "vehicle_id", ["unix_ms", "event_id"])


def repeated_reports(spark: SparkSession, d: str) -> DataFrame:
    """Every report three times, a second apart, the third now and then with another direction; arrival orders them."""
    r = vehicle_reports(spark, d).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    turned = (c("k") == 2) & (c("event_id") % 5 == 0)
    return r.select(
        "vehicle_id", (c("unix_ms") + (c("k") - 1) * 1000).alias("unix_ms"), "route_tag", F.when(turned, F.concat(c("route_tag"), F.lit("_9_var0"))).otherwise(c("dir_tag")).alias("dir_tag"),
        "heading", "lat", "lon", F.struct(c("unix_ms").alias("t"), "event_id", "k").alias("arrival"),
    )


# The same rules as a recursive walk over each vehicle's arrivals.
_FOLD = """rep AS (SELECT vehicle_id, unix_ms + (k - 1) * 1000 AS ms, route_tag, CASE WHEN k = 2 AND event_id % 5 = 0 THEN concat(route_tag, '_9_var0') ELSE dir_tag END AS dir_tag, heading, lat, lon,
    row_number() OVER (PARTITION BY vehicle_id ORDER BY unix_ms, event_id, k) AS i FROM vehicle_reports, (VALUES (0), (1), (2)) t(k)),
walk AS (SELECT vehicle_id, i, ms AS f_ms, route_tag AS f_route, dir_tag AS f_dir, heading AS f_heading, lat AS f_lat, lon AS f_lon, CAST(NULL AS VARCHAR) AS l_dir, 1 AS n, ms AS total,
        CAST(NULL AS BIGINT) AS o_ms, CAST(NULL AS VARCHAR) AS o_dir, CAST(NULL AS VARCHAR) AS o_last FROM rep WHERE i = 1
    UNION ALL SELECT r.vehicle_id, r.i, CASE WHEN m OR late THEN f_ms ELSE r.ms END, CASE WHEN m OR late THEN f_route ELSE r.route_tag END, CASE WHEN m OR late THEN f_dir ELSE r.dir_tag END,
        CASE WHEN m OR late THEN f_heading ELSE r.heading END, CASE WHEN m OR late THEN f_lat ELSE r.lat END, CASE WHEN m OR late THEN f_lon ELSE r.lon END,
        CASE WHEN m THEN CASE WHEN r.route_tag <> f_route OR r.dir_tag <> f_dir THEN r.dir_tag END WHEN late THEN l_dir END, CASE WHEN m THEN n + 1 WHEN late THEN n ELSE 1 END,
        CASE WHEN m THEN total + r.ms WHEN late THEN total ELSE r.ms END, CASE WHEN NOT m AND NOT late THEN CAST(floor(total / n + 5e-1) AS BIGINT) END, CASE WHEN NOT m AND NOT late THEN f_dir END, CASE WHEN NOT m AND NOT late THEN l_dir END
    FROM (SELECT w.*, x.i AS xi, x.heading = f_heading AND x.lat = f_lat AND x.lon = f_lon AND abs(f_ms - x.ms) <= 2000 AS m,
          f_ms > x.ms AND NOT (x.heading = f_heading AND x.lat = f_lat AND x.lon = f_lon AND abs(f_ms - x.ms) <= 2000) AS late FROM walk w JOIN rep x ON x.vehicle_id = w.vehicle_id AND x.i = w.i + 1) s
    JOIN rep r ON r.vehicle_id = s.vehicle_id AND r.i = s.xi)"""
_MERGED = """WITH RECURSIVE {views}, {fold}, outs AS (SELECT vehicle_id, o_ms AS ms, o_dir AS dir_tag, o_last FROM walk WHERE o_ms IS NOT NULL
    UNION ALL SELECT vehicle_id, CAST(floor(total / n + 5e-1) AS BIGINT), f_dir, l_dir FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY i DESC) AS z FROM walk) WHERE z = 1)
SELECT vehicle_id, ms AS unix_ms, dir_tag FROM outs UNION ALL SELECT vehicle_id, ms + 1, o_last FROM outs WHERE o_last IS NOT NULL"""


def _merged_sql(same_tags: bool = False) -> str:
    from .fixtures import VIEWS

    merges = "abs(f_ms - x.ms) <= 2000"
    fold = _FOLD.replace(merges, f"{merges} AND x.route_tag = f_route AND x.dir_tag = f_dir") if same_tags else _FOLD
    return _MERGED.format(views=VIEWS.strip(), fold=fold)


@query("z01_merge", _merged_sql())
def z01(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_reports(repeated_reports(spark, d), "arrival").select("vehicle_id", "unix_ms", "dir_tag")


@query("z06_ordered_release")
def z06(spark: SparkSession, d: str) -> DataFrame:
    """Eight feeds, one for each route, whose responses are the reports of a quarter of an hour."""
    r = vehicle_reports(spark, d).withColumn("response", F.expr("unix_ms DIV 900000"))
    return release.release_reports(r, "response", feed="route_tag").select("feed", "place", "vehicle_id", "unix_ms", "dir_tag")


@query("z02_late_drops", over_views("SELECT vehicle_id, CAST(sum(CASE WHEN unix_ms < before THEN 1 ELSE 0 END) AS BIGINT) AS late FROM (SELECT vehicle_id, unix_ms, max(unix_ms) OVER (PARTITION BY vehicle_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM vehicle_reports) GROUP BY vehicle_id"))
def z02(spark: SparkSession, d: str) -> DataFrame:
    # Places of events differ, so nothing merges and each report older than the newest before it is a drop.
    r = vehicle_reports(spark, d).withColumn("lat", c("event_id").cast("double"))
    dropped = merge.merge_reports(r, "event_id").groupBy("vehicle_id").agg(F.max("dropped").alias("late"))
    return dropped.select("vehicle_id", c("late").cast("long").alias("late"))


@query("z08_same_tags_merge", _merged_sql(same_tags=True))
def z08(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_reports(repeated_reports(spark, d), "arrival", same_tags=True).select("vehicle_id", "unix_ms", "dir_tag")


def feed_documents(spark: SparkSession, d: str) -> DataFrame:
    """Ten reports as one response in XML, with their ages before the newest whole second."""
    r = vehicle_reports(spark, d).withColumn("batch", F.expr("event_id DIV 10"))
    age = (c("event_id") * 7 % 60).cast("string")
    element = F.format_string('<vehicle id="%s" routeTag="%s" dirTag="%s" lat="%s" lon="%s" secsSinceReport="%s" predictable="true" heading="%d"/>', "vehicle_id", "route_tag", "dir_tag", F.round("lat", 6).cast("string"), F.round("lon", 6).cast("string"), age, "heading")
    body = r.groupBy("batch").agg(F.max("unix_ms").alias("last_ms"), F.array_join(F.array_sort(F.collect_list(element)), "").alias("vehicles"))
    return body.select("batch", F.format_string('\n<?xml version="1.0"?><body>%s<lastTime time="%d"/></body>', "vehicles", "last_ms").alias("xml"))


@query("s13_vehicle_xml", over_views("SELECT batch, vehicle_id, route_tag, dir_tag, last_ms + (least_age - age) * 1000 AS unix_ms, CASE WHEN heading >= -2 THEN heading ELSE -1 END AS heading, round(lat, 6) AS lat FROM (SELECT *, event_id // 10 AS batch, event_id * 7 % 60 AS age, max(unix_ms) OVER (PARTITION BY event_id // 10) AS last_ms, min(event_id * 7 % 60) OVER (PARTITION BY event_id // 10) AS least_age FROM vehicle_reports)"))
def s13(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import feed_xml

    return feed_xml.vehicle_reports(feed_documents(spark, d)).select("batch", "vehicle_id", "route_tag", "dir_tag", "unix_ms", "heading", F.round("lat", 6).alias("lat"))


@query("s17_paths_xml", over_views("SELECT path_index, route_tag, CAST(count(*) + 1 AS INT) AS points, round(sum(lat1), 5) AS lat_sum FROM path_segments GROUP BY ALL"))
def s17(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import feed_xml
    from .fixtures import path_segments
    from .join_queries import waypoints

    point = F.struct("position", F.format_string('<point lat="%s" lon="%s"/>', c("y").cast("string"), c("x").cast("string")).alias("x"))
    points = waypoints(spark).groupBy("path_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(point)), lambda p: p["x"]), "").alias("points"))
    tags = path_segments(spark).select("path_index", "route_tag").distinct()
    xml = points.join(tags, "path_index").select(F.format_string('<body><path index="%d"><route tag="%s"/>%s</path></body>', "path_index", "route_tag", "points").alias("xml"))
    p = feed_xml.parse(xml, "xml", feed_xml.PATHS).select(F.explode("body.path").alias("p"))
    inner = F.slice("p.point", F.lit(1), F.size("p.point") - 1)
    total = F.aggregate(inner, F.lit(0.0), lambda a, w: a + w["_lat"])
    return p.select(c("p._index").cast("long").alias("path_index"), F.get("p.route", F.lit(0))["_tag"].alias("route_tag"), F.size("p.point").alias("points"), F.round(total, 5).alias("lat_sum"))


@query("s18_archive_time", over_views("SELECT event_id, CASE event_id % 4 WHEN 0 THEN unix_ms WHEN 1 THEN unix_ms // 1000 * 1000 WHEN 2 THEN unix_ms END AS ms FROM vehicle_reports"))
def s18(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import feed_xml

    ms = c("unix_ms").cast("string")
    clock = F.date_format(when.ms_to_utc(c("unix_ms")), "HHmmss.SSS")
    name = F.when(c("event_id") % 4 == 0, F.concat(ms, F.lit(".xml"))).when(c("event_id") % 4 == 1, F.concat(F.lit("raw/"), when.stamp(c("unix_ms")), F.lit(".xml"))).when(c("event_id") % 4 == 2, F.concat(clock, F.lit(".xml"))).otherwise(F.lit("note.xml"))
    # Files were last changed up to ten hours before or after their time.
    changed = c("unix_ms") + (c("event_id") * 7919 % 72_000 - 36_000) * 1000
    return vehicle_reports(spark, d).select("event_id", feed_xml.archive_time(F.replace(name, F.lit(" "), F.lit("_")), changed).alias("ms"))


@query("s08_file_order", "SELECT doc_id, row_number() OVER (ORDER BY strftime(DATE '2014-01-01' + CAST(doc_id % 200 AS INT), '%Y%m%d') DESC, printf('raw/%06d', doc_id)) AS place FROM documents")
def s08(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import archives

    day = F.date_format(F.date_add(F.lit("2014-01-01").cast("date"), (c("doc_id") % 200).cast("int")), "yyyy-MM-dd")
    path = F.concat(F.format_string("raw/%06d", "doc_id"), F.lit("-"), day, F.lit(".csv"))
    listing = table(spark, d, "documents").select("doc_id", path.alias("path"), F.current_timestamp().alias("modificationTime"))
    # A listing is small; its one order is the result.
    return archives.ordered(listing).select("doc_id", F.row_number().over(Window.orderBy(F.desc("file_date"), "path")).cast("long").alias("place"))


@query("e03_equal_configs", r"SELECT page_id, html = replace(html, '</head>', '<!-- x --></head>') AS same_bytes, md5(regexp_replace(html, '(?s)[ \n]*<!--.*?-->[ \n]*', '', 'g')) = md5(regexp_replace(replace(html, '</head>', '<!-- x --></head>'), '(?s)[ \n]*<!--.*?-->[ \n]*', '', 'g')) AS same FROM pages")
def e03(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import catalog

    other = F.replace("html", F.lit("</head>"), F.lit("<!-- x --></head>"))
    return table(spark, d, "pages").select("page_id", (c("html") == other).alias("same_bytes"), catalog.equal_configs(c("html"), other).alias("same"))
