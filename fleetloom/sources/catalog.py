"""The catalogue of an agency as relational tables, from parsed route elements (see feed_xml.routes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _set(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def consistent(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row for each key: the least non-empty value of each column, and <column>_mismatch where there are several."""
    aggs = []
    for c in columns:
        v = _set(F.col(c)) if dict(df.dtypes)[c] == "string" else F.col(c)
        aggs += [F.min(v).alias(c), (F.count_distinct(v) > 1).alias(f"{c}_mismatch")]
    return df.groupBy(key).agg(*aggs)


def routes(r: DataFrame) -> DataFrame:
    """tag, title, colours, bounds, errors of each route; tag, title, directions and bounds are required."""
    missing = lambda test, what: F.when(test, F.lit(what))
    errors = F.array_compact(
        F.array(
            missing(_set(F.col("_tag")).isNull(), "no tag"), missing(_set(F.col("_title")).isNull(), "no title"), missing(F.coalesce(F.size("direction"), F.lit(0)) < 1, "no directions"),
            missing(F.col("_latMin").isNull() | F.col("_latMax").isNull() | F.col("_lonMin").isNull() | F.col("_lonMax").isNull(), "no bounds"),
        )
    )
    return r.select(
        F.col("_tag").alias("route_tag"), F.col("_title").alias("title"), F.col("_color").alias("color"), F.col("_oppositeColor").alias("opposite_color"),
        F.col("_latMin").alias("lat_min"), F.col("_latMax").alias("lat_max"), F.col("_lonMin").alias("lon_min"), F.col("_lonMax").alias("lon_max"), errors.alias("errors"),
    )


def until_first_bad(routes_df: DataFrame, order: str) -> DataFrame:
    """Routes of the files before the first one, in this order, that has an error: what a scan of a directory holds when it stops."""
    bad = routes_df.filter(F.size("errors") > 0).agg(F.min(order).alias("_bad"))
    return routes_df.crossJoin(F.broadcast(bad)).filter(F.col("_bad").isNull() | (F.col(order) < F.col("_bad"))).drop("_bad")  # one row


def stops(r: DataFrame) -> DataFrame:
    """stop_tag, title, stop_id, lat, lon with mismatch flags; a stop needs a tag, a title and a location other than 0, 0."""
    s = r.select(F.explode("stop").alias("s")).select(F.col("s._tag").alias("stop_tag"), F.col("s._title").alias("title"), F.col("s._stopId").alias("stop_id"), F.col("s._lat").alias("lat"), F.col("s._lon").alias("lon"))
    return consistent(s.filter("stop_tag <> '' AND title <> '' AND (lat <> 0 OR lon <> 0)"), "stop_tag", "title", "stop_id", "lat", "lon")


def directions(r: DataFrame) -> DataFrame:
    """dir_tag, route_tag, title, name, use_for_ui."""
    d = r.select(F.col("_tag").alias("route_tag"), F.explode("direction").alias("d"))
    return d.select(F.col("d._tag").alias("dir_tag"), "route_tag", F.col("d._title").alias("title"), F.col("d._name").alias("name"), F.col("d._useForUI").alias("use_for_ui"))


def direction_stops(r: DataFrame) -> DataFrame:
    """dir_tag, seq, stop_tag, repeated, unknown: each direction's own stops in order; unknown ones aren't among the route's."""
    d = r.select(F.transform(F.coalesce("stop", F.array().cast(r.schema["stop"].dataType)), lambda s: s["_tag"]).alias("known"), F.explode("direction").alias("d"))
    s = d.select(F.col("d._tag").alias("dir_tag"), "known", F.transform("d.stop", lambda s: s["_tag"]).alias("tags"))
    e = s.select("dir_tag", "known", "tags", F.posexplode("tags").alias("seq", "stop_tag"))
    earlier = F.array_contains(F.slice("tags", F.lit(1), F.col("seq")), F.col("stop_tag"))
    return e.select("dir_tag", "seq", "stop_tag", earlier.alias("repeated"), (~F.array_contains("known", F.col("stop_tag"))).alias("unknown"))


def paths(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paths: path_index, waypoints; path_routes: path_index, route_tag). Equal waypoints are one path, indexed from 1 as first seen.

    First seen is by route tag and place in the route, so that the index doesn't depend on how rows are dealt out. Paths with an
    invalid point are left out. The catalogue's distinct paths are few, so one order over them is no burden.
    """
    p = r.select(F.col("_tag").alias("route_tag"), F.posexplode("path").alias("pos", "p"))
    p = p.select("route_tag", "pos", F.transform("p.point", lambda x: F.struct(x["_lat"].alias("lat"), x["_lon"].alias("lon"))).alias("waypoints"))
    p = p.filter(F.forall("waypoints", lambda x: x["lat"].between(-90, 90) & x["lon"].between(-180, 180)))
    first = p.groupBy("waypoints").agg(F.min(F.struct("route_tag", "pos")).alias("seen"), F.collect_set("route_tag").alias("tags"))
    indexed = first.withColumn("path_index", F.row_number().over(Window.orderBy("seen")).cast("long"))
    return indexed.select("path_index", "waypoints"), indexed.select("path_index", F.explode("tags").alias("route_tag"))


def locations(r: DataFrame) -> DataFrame:
    """Distinct lat, lon of stops and waypoints."""
    s = r.select(F.explode("stop").alias("s")).select(F.col("s._lat").alias("lat"), F.col("s._lon").alias("lon"))
    w = r.select(F.explode("path").alias("p")).select(F.explode("p.point").alias("w")).select(F.col("w._lat").alias("lat"), F.col("w._lon").alias("lon"))
    return s.union(w).distinct()


def paths_xml(paths_df: DataFrame, path_routes: DataFrame) -> DataFrame:
    """path_index, xml: each path as an element with its routes and points, in order of the index."""
    tags = path_routes.groupBy("path_index").agg(F.sort_array(F.collect_set("route_tag")).alias("tags"))
    point = lambda w: F.format_string('<point lat="%s" lon="%s"/>', w["lat"].cast("string"), w["lon"].cast("string"))
    route = lambda t: F.format_string('<route tag="%s"/>', t)
    body = F.concat(F.format_string('<path index="%d">', "path_index"), F.array_join(F.transform("tags", route), ""), F.array_join(F.transform("waypoints", point), ""), F.lit("</path>"))
    return paths_df.join(tags, "path_index").select("path_index", body.alias("xml")).orderBy("path_index")


def canonical_xml(x: Column) -> Column:
    """XML with what doesn't change its tree taken out: comments, blanks between elements, the order and quotes of attributes, short forms of empty elements."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(x, r"(?s)\s*<!--.*?-->\s*", ""), r">\s+<", "><"))
    pieces = F.regexp_extract_all(plain, F.lit(r"(<(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>|[^<]+)"), F.lit(1))

    def piece(t: Column) -> Column:
        name = F.regexp_extract(t, r"^<(/?[^\s/>]+)", 1)
        given = F.regexp_extract_all(t, F.lit(r"\s([^\s=/>]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))"), F.lit(1))
        attributes = F.sort_array(F.transform(given, lambda a: F.regexp_replace(a, r"(?s)^([^\s=]+)\s*=\s*[\"'](.*)[\"']$", '$1="$2"')))
        opened = F.concat(F.lit("<"), name, F.array_join(F.transform(attributes, lambda a: F.concat(F.lit(" "), a)), ""), F.lit(">"))
        closed = F.when(t.endswith("/>"), F.concat(F.lit("</"), name, F.lit(">"))).otherwise("")
        return F.when(t.startswith("<?") | t.startswith("<!") | ~t.startswith("<"), t).otherwise(F.concat(opened, closed))

    return F.array_join(F.transform(pieces, piece), "")


def equal_configs(first: Column, second: Column) -> Column:
    """Whether two configuration files say the same: equal bytes, or for XML an equal tree."""
    xml = F.ltrim(first).startswith("<") & F.ltrim(second).startswith("<")
    return (first == second) | (xml & (canonical_xml(first) == canonical_xml(second)))
