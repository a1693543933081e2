"""Queries of an agency's catalogue, its schedules and its archives' metadata, from XML made of the test paths and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import spatial
from ..sources import archives, catalog, csv_rows, feed_xml
from .core import query
from .fixtures import PATHS, ROUTES, over_views, path_segments, table, vehicle_reports
from .join_queries import waypoints

c = F.col

# The catalogue in SQL: w has the waypoints, rp the paths that a route lists (its own, then the first of the next route), rs its stops (at the start of each own path and of the path after it).
_CATALOG = [
    "w AS (SELECT path_index AS p, seg_index AS k, round(lat1, 6) AS lat, round(lon1, 6) AS lon FROM path_segments UNION ALL SELECT path_index, 9, round(lat2, 6), round(lon2, 6) FROM path_segments WHERE seg_index = 8)",
    f"rp AS (SELECT path_index % {ROUTES} AS r, path_index AS p, path_index // {ROUTES} AS pos FROM path_segments WHERE seg_index = 0 UNION ALL SELECT range, (range + 1) % {ROUTES}, {PATHS // ROUTES} FROM range({ROUTES}))",
    f"rs AS (SELECT r, p, 'Stop ' || p AS title FROM rp WHERE pos < {PATHS // ROUTES} UNION ALL SELECT r, (p + 1) % {PATHS}, 'Stop ' || ((p + 1) % {PATHS}) || CASE WHEN (p + 1) % 5 = 0 THEN ' West' ELSE '' END FROM rp WHERE pos < {PATHS // ROUTES})",
]


def route_documents(spark: SparkSession) -> DataFrame:
    """r, xml: a response for each route, with stops that lack a title or a place, unknown and repeated stops of directions, and a path off the earth."""
    own = PATHS // ROUTES
    text = lambda x: x.cast("string")
    w = waypoints(spark).select(c("path_index").alias("p"), "position", F.round("y", 6).alias("lat"), F.round("x", 6).alias("lon"))
    point = F.struct("position", F.format_string('<point lat="%s" lon="%s"/>', text(c("lat")), text(c("lon"))).alias("x"))
    shapes = w.groupBy("p").agg(F.concat(F.lit("<path>"), F.array_join(F.transform(F.array_sort(F.collect_list(point)), lambda q: q["x"]), ""), F.lit("</path>")).alias("path"), F.min_by(F.struct("lat", "lon"), "position").alias("at"))
    listed = spark.range(PATHS).select((c("id") % ROUTES).alias("r"), c("id").alias("p"), F.expr(f"id DIV {ROUTES}").alias("pos"))
    listed = listed.union(spark.range(ROUTES).select("id", (c("id") + 1) % ROUTES, F.lit(own).cast("long")))
    paths = listed.join(shapes, "p").groupBy("r").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "path"))), lambda q: q["path"]), "").alias("paths"))
    mine = listed.filter(c("pos") < own)
    after = mine.select("r", ((c("p") + 1) % PATHS).alias("p"), (c("pos") + own).alias("pos"), F.lit(True).alias("other"))
    stops = mine.select("r", "p", "pos", F.lit(False).alias("other")).union(after).join(shapes, "p")
    title = F.concat(F.lit("Stop "), text(c("p")), F.when(c("other") & (c("p") % 5 == 0), " West").otherwise(""))
    stop = F.format_string('<stop tag="s%d" title="%s" lat="%s" lon="%s" stopId="%d"/>', "p", title, text(c("at.lat")), text(c("at.lon")), "p")
    stops = stops.groupBy("r").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", stop.alias("x")))), lambda q: q["x"]), "").alias("stops"))
    calls = mine.groupBy("r").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    tags = lambda ps: F.array_join(F.transform(ps, lambda p: F.format_string('<stop tag="s%d"/>', p)), "")
    way = lambda i, ps, more: F.concat(F.format_string(f'<direction tag="%d_{i}_var0" title="To {i}" name="{("Outbound", "Inbound")[i]}" useForUI="{("true", "false")[i]}">', "r"), tags(ps), more, F.lit("</direction>"))
    bounds = w.select((c("p") % ROUTES).alias("r"), "lat", "lon").groupBy("r").agg(*(f(k).alias(f"{k}_{n}") for k in ("lat", "lon") for n, f in (("min", F.min), ("max", F.max))))
    box = F.when(c("r") != 7, F.format_string(' latMin="%s" latMax="%s" lonMin="%s" lonMax="%s"', *(text(c(k)) for k in ("lat_min", "lat_max", "lon_min", "lon_max")))).otherwise("")
    body = F.concat(
        F.format_string('<body><route tag="%d" title="%s" color="ff%02d00" oppositeColor="ffffff"', "r", F.when(c("r") == 6, "").otherwise(F.format_string("Route %d", "r")), "r"), box, F.lit(">"), "stops",
        F.format_string('<stop tag="e%d" title="" lat="42.2" lon="-71.1"/><stop tag="z%d" title="Zero" lat="0" lon="0"/>', "r", "r"), way(0, c("ps"), F.lit("")), way(1, F.reverse("ps"), F.concat(tags(F.slice("ps", 1, 1)), F.format_string('<stop tag="x%d"/>', "r"))),
        "paths", F.when(c("r") == 3, '<path><point lat="142.3" lon="0"/></path>').otherwise(""), F.lit("</route></body>"),
    )
    return stops.join(paths, "r").join(calls, "r").join(bounds, "r").select("r", body.alias("xml"))


def catalogue(spark: SparkSession) -> DataFrame:
    return feed_xml.routes(route_documents(spark))


@query(
    "m01_routes",
    over_views(
        f"SELECT CAST(r AS VARCHAR) AS route_tag, CASE WHEN r = 6 THEN '' ELSE 'Route ' || r END AS title, printf('ff%02d00', r) AS color, CASE WHEN r <> 7 THEN min(lat) END AS lat_min, CASE WHEN r <> 7 THEN max(lat) END AS lat_max, CASE WHEN r <> 7 THEN min(lon) END AS lon_min, CASE WHEN r <> 7 THEN max(lon) END AS lon_max, CASE r WHEN 6 THEN 'no title' WHEN 7 THEN 'no bounds' ELSE '' END AS errors FROM (SELECT p % {ROUTES} AS r, lat, lon FROM w) GROUP BY r",
        *_CATALOG,
    ),
)
def m01(spark: SparkSession, d: str) -> DataFrame:
    r = catalog.routes(catalogue(spark))
    return r.select("route_tag", "title", "color", "lat_min", "lat_max", "lon_min", "lon_max", F.array_join("errors", "; ").alias("errors"))


@query("s16_until_first_bad", "SELECT CAST(range AS VARCHAR) AS route_tag FROM range(6)")
def s16(spark: SparkSession, d: str) -> DataFrame:
    return catalog.until_first_bad(catalog.routes(catalogue(spark)), "route_tag").select("route_tag")


@query("m02_stops", over_views("SELECT 's' || rs.p AS stop_tag, min(title) AS title, CAST(rs.p AS VARCHAR) AS stop_id, min(lat) AS lat, min(lon) AS lon, count(DISTINCT title) > 1 AS mismatch FROM rs JOIN w ON w.p = rs.p AND k = 0 GROUP BY rs.p", *_CATALOG))
def m02(spark: SparkSession, d: str) -> DataFrame:
    return catalog.stops(catalogue(spark)).select("stop_tag", "title", "stop_id", "lat", "lon", c("title_mismatch").alias("mismatch"))


@query("m03_directions", "SELECT r || '_' || i || '_var0' AS dir_tag, CAST(r AS VARCHAR) AS route_tag, 'To ' || i AS title, CASE i WHEN 0 THEN 'Outbound' ELSE 'Inbound' END AS name, i = 0 AS use_for_ui FROM (SELECT a.range AS r, b.range AS i FROM range(8) a, range(2) b)")
def m03(spark: SparkSession, d: str) -> DataFrame:
    return catalog.directions(catalogue(spark))


_OWN = PATHS // ROUTES


@query(
    "m03_direction_stops",
    f"""SELECT r || '_0_var0' AS dir_tag, CAST(q AS INT) AS seq, 's' || (r + {ROUTES} * q) AS stop_tag, false AS repeated, false AS unknown FROM (SELECT a.range AS r, b.range AS q FROM range({ROUTES}) a, range({_OWN}) b)
    UNION ALL SELECT r || '_1_var0', CAST(q AS INT), CASE WHEN q < {_OWN} THEN 's' || (r + {ROUTES} * ({_OWN - 1} - q)) WHEN q = {_OWN} THEN 's' || r ELSE 'x' || r END, q = {_OWN}, q > {_OWN} FROM (SELECT a.range AS r, b.range AS q FROM range({ROUTES}) a, range({_OWN + 2}) b)""",
)
def m03_stops(spark: SparkSession, d: str) -> DataFrame:
    return catalog.direction_stops(catalogue(spark))


_PATHS_SQL = "ix AS (SELECT p, row_number() OVER (ORDER BY min(r * 100 + pos)) AS path_index, string_agg(CAST(r AS VARCHAR), ',' ORDER BY r) AS routes FROM rp GROUP BY p)"


@query("m04_paths", over_views("SELECT path_index, routes, count(*) AS points, round(sum(lat), 5) AS lat_sum FROM ix JOIN w ON w.p = ix.p GROUP BY ALL", *_CATALOG, _PATHS_SQL))
def m04(spark: SparkSession, d: str) -> DataFrame:
    paths, bridge = catalog.paths(catalogue(spark))
    tags = bridge.groupBy("path_index").agg(F.array_join(F.array_sort(F.collect_list("route_tag")), ",").alias("routes"))
    total = F.aggregate("waypoints", F.lit(0.0), lambda a, p: a + p["lat"])
    return paths.join(tags, "path_index").select("path_index", "routes", F.size("waypoints").cast("long").alias("points"), F.round(total, 5).alias("lat_sum"))


@query("j04_segments", over_views("SELECT path_index, s.k AS seg_index, round(sqrt(power(t.lon - s.lon, 2) + power(t.lat - s.lat, 2)), 6) AS length FROM ix JOIN w s ON s.p = ix.p JOIN w t ON t.p = ix.p AND t.k = s.k + 1", *_CATALOG, _PATHS_SQL))
def j04(spark: SparkSession, d: str) -> DataFrame:
    """Segments from the catalogue's paths."""
    points = catalog.paths(catalogue(spark))[0].select("path_index", F.posexplode("waypoints").alias("position", "p"))
    points = points.select("path_index", c("position").cast("long").alias("position"), c("p.lon").alias("x"), c("p.lat").alias("y"))
    return spatial.directed_segments(points).select("path_index", "seg_index", F.round("length", 6).alias("length"))


@query("m05_locations", over_views("SELECT lat, lon FROM w UNION SELECT 422e-1, -711e-1 UNION SELECT 0e0, 0e0 UNION SELECT 1423e-1, 0e0", *_CATALOG))
def m05(spark: SparkSession, d: str) -> DataFrame:
    return catalog.locations(catalogue(spark)).select("lat", "lon")


@query("k11_paths_xml", over_views("SELECT path_index, routes, count(*) AS points, round(sum(lon), 5) AS lon_sum FROM ix JOIN w ON w.p = ix.p GROUP BY ALL", *_CATALOG, _PATHS_SQL))
def k11(spark: SparkSession, d: str) -> DataFrame:
    """Written as XML and read again."""
    xml = catalog.paths_xml(*catalog.paths(catalogue(spark))).select(F.concat(F.lit("<body>"), "xml", F.lit("</body>")).alias("xml"))
    p = feed_xml.parse(xml, "xml", feed_xml.PATHS).select(F.explode("body.path").alias("p"))
    total = F.aggregate("p.point", F.lit(0.0), lambda a, q: a + q["_lon"])
    return p.select(c("p._index").cast("long").alias("path_index"), F.array_join(F.transform("p.route", lambda t: t["_tag"]), ",").alias("routes"), F.size("p.point").cast("long").alias("points"), F.round(total, 5).alias("lon_sum"))


@query("s15_schedule_times", "SELECT CAST(o_custkey AS VARCHAR) AS route_tag, CAST(o_orderkey AS VARCHAR) AS block_id, CAST(l_linenumber AS INT) - 1 AS seq, 'p' || l_partkey AS stop_tag, CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_suppkey AS BIGINT) * 1000 END AS epoch_ms FROM (SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS l_linenumber FROM lineitem) JOIN orders ON o_orderkey = l_orderkey")
def s15(spark: SparkSession, d: str) -> DataFrame:
    """Each order as a block whose lines are its stops; every third stop has no time."""
    lines = table(spark, d, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("ls"))
    stop = lambda x, i: F.concat(F.lit('<stop tag="p'), x["l_partkey"].cast("string"), F.lit('" epochTime="'), F.when((i + 1) % 3 == 0, "-1").otherwise((x["l_suppkey"].cast("long") * 1000).cast("string")), F.lit('">x</stop>'))
    xml = F.format_string('<body><route tag="%s" direction="out"><tr blockID="%s">%s</tr></route></body>', c("o_custkey").cast("string"), c("o_orderkey").cast("string"), F.array_join(F.transform("ls", stop), ""))
    out = feed_xml.schedule_times(table(spark, d, "orders").select("o_orderkey", "o_custkey").join(lines, "o_orderkey").select(xml.alias("xml")))
    return out.select("route_tag", "block_id", "seq", "stop_tag", "epoch_ms")


@query("s19_archive_comments", over_views("SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN 'http://feed/?t=' || unix_ms END AS url, CASE WHEN event_id % 4 <> 3 THEN CAST(unix_ms + 250 AS VARCHAR) END AS response_time, CASE WHEN event_id % 4 = 1 THEN 'text/xml' END AS content_type FROM vehicle_reports"))
def s19(spark: SparkSession, d: str) -> DataFrame:
    head = F.concat(F.lit("URL=http://feed/?t="), c("unix_ms").cast("string"), F.lit("\nResponseTime="), (c("unix_ms") + 250).cast("string"))
    comment = F.when(c("event_id") % 4 == 3, "a note").when(c("event_id") % 4 == 1, F.concat(head, F.lit("\n\nContent-Type: text/xml\nServer: s"))).otherwise(head)
    r = vehicle_reports(spark, d).select("event_id", feed_xml.archive_metadata(comment).alias("m"), feed_xml.archive_headers(comment).alias("h"))
    return r.select("event_id", F.col("m")["URL"].alias("url"), F.col("m")["ResponseTime"].alias("response_time"), F.when(c("m").isNotNull(), F.col("h")["Content-Type"]).alias("content_type"))


@query("k07_commented_response", "SELECT page_id, CASE WHEN html IS NOT NULL THEN regexp_replace(html, '(?i)<html', concat('<!--', chr(10), 'Page=', page_id, chr(10), 'URL=', url, chr(10), '-->', chr(10), '<html')) END AS body FROM pages")
def k07(spark: SparkSession, d: str) -> DataFrame:
    meta = F.create_map(F.lit("URL"), c("url"), F.lit("Page"), c("page_id").cast("string"))
    return table(spark, d, "pages").select("page_id", feed_xml.with_comment(c("html"), meta).alias("body"))


@query("s24_config_directories", "SELECT 'config/' || source || '/' || lang AS directory, count(*) AS files FROM documents GROUP BY ALL")
def s24(spark: SparkSession, d: str) -> DataFrame:
    """Each document as a file beside its directory's route list; only directories with a list count."""
    docs = table(spark, d, "documents").select(F.concat(F.lit("config/"), "source", F.lit("/"), "lang").alias("directory"), "doc_id")
    listing = docs.select(F.concat("directory", F.lit("/routeList.xml")).alias("path"), F.current_timestamp().alias("modificationTime")).distinct()
    listing = listing.union(docs.select(F.concat(F.lit("other/"), c("doc_id").cast("string"), F.lit(".xml")), F.current_timestamp()))
    return archives.config_directories(listing).select("directory").join(docs, "directory").groupBy("directory").agg(F.count("*").alias("files"))


@query("p10_kept_paths", "SELECT doc_id FROM documents WHERE lang <> 'fr' AND doc_id NOT IN (SELECT doc_id FROM documents WHERE source = 'src3')")
def p10(spark: SparkSession, d: str) -> DataFrame:
    folder = F.when(c("lang") == "fr", "logs").when(c("source") == "src3", "config").otherwise("mbta")
    listing = table(spark, d, "documents").select("doc_id", F.concat(F.lit("/data/"), folder, F.lit("/"), c("doc_id").cast("string"), F.lit(".csv")).alias("path"))
    return listing.filter(csv_rows.kept_path(c("path"))).select("doc_id")
