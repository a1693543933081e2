"""Feed responses and route catalogues as XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, xml

VEHICLES = (
    "vehicle array<struct<_id string, _routeTag string, _dirTag string, _lat double, _lon double, _secsSinceReport int, _predictable boolean, _heading int, _speedKmHr double>>, "
    "lastTime struct<_time bigint>, Error struct<_shouldRetry boolean, _VALUE string>"
)
ROUTES = (
    "route array<struct<_tag string, _title string, _color string, _oppositeColor string, _latMin double, _latMax double, _lonMin double, _lonMax double, "
    "stop array<struct<_tag string, _title string, _lat double, _lon double, _stopId string>>, "
    "direction array<struct<_tag string, _title string, _name string, _useForUI boolean, stop array<struct<_tag string>>>>, "
    "path array<struct<point array<struct<_lat double, _lon double>>>>>>, Error struct<_shouldRetry boolean, _VALUE string>"
)
SCHEDULES = (
    "route array<struct<_tag string, _title string, _scheduleClass string, _serviceClass string, _direction string, "
    "tr array<struct<_blockID string, stop array<struct<_tag string, _epochTime bigint, _VALUE string>>>>>>"
)
PATHS = "path array<struct<_index int, route array<struct<_tag string, _title string, direction array<struct<_tag string, _title string>>>>, point array<struct<_lat double, _lon double>>>>"


def parse(df: DataFrame, column: str, schema: str, name: str = "body") -> DataFrame:
    """With the parsed tree; blanks before the XML declaration are passed over."""
    return df.withColumn(name, F.from_xml(F.ltrim(F.regexp_replace(column, r"^\s+", "")), schema, {"mode": "PERMISSIVE"}))


def report_time(last_ms: Column, ages: Column) -> Column:
    """When the response was made: the last time plus the least age of a report, in seconds."""
    return (last_ms + F.array_min(ages).cast("long") * 1000).cast("long")


def vehicle_reports(responses: DataFrame, column: str = "xml") -> DataFrame:
    """One row for each vehicle of each response: unix_ms, vehicle_id, route_tag, dir_tag, heading, lat, lon, error.

    Each report's time is the response's minus its age. An Error element, or a missing last time, gives one row with error.
    """
    kept = [c for c in responses.columns if c != column]
    b = parse(responses, column, VEHICLES)
    ages = F.transform("body.vehicle", lambda v: v["_secsSinceReport"])
    at = F.coalesce(F.col("body.lastTime._time"), F.lit(0))
    error = F.when(F.col("body.Error").isNotNull(), F.trim("body.Error._VALUE")).when(at <= 0, "no last time")
    b = b.select(*kept, error.alias("error"), F.col("body.Error._shouldRetry").alias("should_retry"), report_time(at, ages).alias("report_ms"), F.when(error.isNull(), F.col("body.vehicle")).alias("vs"))
    b = b.select(*kept, "error", "should_retry", "report_ms", F.explode_outer("vs").alias("v")).filter("v IS NOT NULL OR error IS NOT NULL")
    lat, lon = F.col("v._lat"), F.col("v._lon")
    bad = F.when(F.col("v").isNotNull() & ~F.coalesce(geo.latitude_valid(lat) & geo.longitude_valid(lon), F.lit(False)), "location")
    return b.select(
        *kept, (F.col("report_ms") - F.col("v._secsSinceReport").cast("long") * 1000).alias("unix_ms"), F.col("v._id").alias("vehicle_id"), F.col("v._routeTag").alias("route_tag"),
        F.col("v._dirTag").alias("dir_tag"), F.coalesce(geo.heading_or_invalid(F.col("v._heading")), F.lit(-1)).alias("heading"), lat.alias("lat"), lon.alias("lon"), F.coalesce("error", bad).alias("error"), "should_retry",
    )


def routes(documents: DataFrame, column: str = "xml") -> DataFrame:
    """One row for each route element, fields of the element in place."""
    return parse(documents, column, ROUTES).select(F.explode("body.route").alias("r")).select("r.*")


def schedule_times(documents: DataFrame, column: str = "xml") -> DataFrame:
    """route_tag, direction, block_id, seq, stop_tag, epoch_ms; an absent time (-1) is null."""
    r = parse(documents, column, SCHEDULES).select(F.explode("body.route").alias("r"))
    t = r.select(F.col("r._tag").alias("route_tag"), F.col("r._direction").alias("direction"), F.explode("r.tr").alias("tr"))
    s = t.select("route_tag", "direction", F.col("tr._blockID").alias("block_id"), F.posexplode("tr.stop").alias("seq", "stop"))
    return s.select("route_tag", "direction", "block_id", "seq", F.col("stop._tag").alias("stop_tag"), F.nullif(F.col("stop._epochTime"), F.lit(-1)).alias("epoch_ms"))


def archive_metadata(comment: Column) -> Column:
    """The map of `k=v` lines of an archive comment, which must start with URL=; null otherwise."""
    block = F.split(F.trim(comment), r"\n[ \t]*\n", 2)[0]
    return F.when(F.trim(comment).startswith("URL="), F.str_to_map(block, F.lit("\n"), F.lit("=")))


def archive_headers(comment: Column) -> Column:
    """The map of `Header: value` lines after the blank line."""
    parts = F.split(F.trim(comment), r"\n[ \t]*\n", 2)
    return F.when(F.size(parts) > 1, F.str_to_map(F.get(parts, F.lit(1)), F.lit("\n"), F.lit(": ")))


DAY_MS = 86_400_000


def archive_time(name: Column, changed_ms: Column | None = None) -> Column:
    """Milliseconds from an archived file's name: 13 digits, 10 digits, yyyymmdd_hhmmss, or hhmmss with a fraction; null for others.

    A time of day needs changed_ms, when the file was last changed: it is that day's time, or the next or last day's where that is nearer, as
    a file made before midnight may be changed after it.
    """
    base = F.regexp_extract(name, r"([^/]+?)(?:\.xml)?$", 1)
    ms = F.regexp_extract(base, r"^(\d{11,})$", 1).try_cast("long")
    seconds = F.regexp_extract(base, r"^(\d{10})$", 1).try_cast("long") * 1000
    stamp = F.regexp_extract(base, r"^(\d{8}_\d{6})$", 1)
    parsed = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")) * 1000
    known = F.coalesce(ms, seconds, parsed)
    if changed_ms is None:
        return known
    digits = lambda i: F.regexp_extract(base, r"^([01]\d|2[0-3])([0-5]\d)([0-5]\d)(?:\.(\d{1,3}))?$", i)
    clock = (digits(1).try_cast("int") * 3600 + digits(2).try_cast("int") * 60 + digits(3).try_cast("int")).cast("long") * 1000 + F.coalesce(F.rpad(F.nullif(digits(4), F.lit("")), 3, "0").try_cast("int"), F.lit(0))
    same_day = changed_ms - F.pmod(changed_ms, F.lit(DAY_MS)) + clock
    off = same_day - changed_ms
    near = F.when(off > DAY_MS // 2, same_day - DAY_MS).when(off < -DAY_MS // 2, same_day + DAY_MS).otherwise(same_day)
    return F.coalesce(known, near)


def with_comment(text: Column, metadata: Column) -> Column:
    """A response for the raw archive: its metadata (a map) as k=v lines in a comment before the root element."""
    lines = F.array_join(F.transform(F.array_sort(F.map_entries(metadata)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "\n")
    at = F.coalesce(xml.root_offset(text), F.lit(0))
    return F.concat(F.substring(text, F.lit(1), at), F.lit("<!--\n"), lines, F.lit("\n-->\n"), F.substring(text, at + 1, F.length(text)))
