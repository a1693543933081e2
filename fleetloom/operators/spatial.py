"""Spatial joins by grid cells: equality on a cell, then the exact test. Catalyst never sees a bare range predicate.

Both sides list the cells of their boxes; a pair that shares several cells is kept in one of them only, the one that
holds the lower left corner of the overlap of the two boxes, so no pair has to be removed afterwards and nothing
is shuffled for that. Which side, if any, is broadcast is left to the size that Spark measures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom


def with_cells(df: DataFrame, box: geom.Rect, size: float, prefix: str) -> DataFrame:
    """A row for each cell of the box, with the box in columns."""
    names = [f"{prefix}{k}" for k in ("x0", "x1", "y0", "y1")]
    df = df.withColumns(dict(zip(names, box, strict=True)))
    cell = lambda c: F.floor(F.col(c) / size)
    df = df.withColumn("cell_x", F.explode(F.sequence(cell(names[0]), cell(names[1]))))
    return df.withColumn("cell_y", F.explode(F.sequence(cell(names[2]), cell(names[3]))))


def range_join(left: DataFrame, right: DataFrame, left_box: geom.Rect, right_box: geom.Rect, size: float, exact: Column, on: Sequence[str] = ()) -> DataFrame:
    """Pairs whose boxes overlap openly and that pass the exact test; on: further columns that must agree.

    A box without extent counts as its point. Columns of the two sides must have different names, but for those in on.
    """
    l, r = with_cells(left, left_box, size, "_l_"), with_cells(right, right_box, size, "_r_")
    corner = lambda lo: F.floor(F.greatest(F.col(f"_l_{lo}"), F.col(f"_r_{lo}")) / size)
    box = lambda p: tuple(F.col(f"{p}{k}") for k in ("x0", "x1", "y0", "y1"))
    pairs = l.join(r, ["cell_x", "cell_y", *on])
    pairs = pairs.filter((F.col("cell_x") == corner("x0")) & (F.col("cell_y") == corner("y0")) & geom.overlaps_open(box("_l_"), box("_r_")) & exact)
    return pairs.drop("cell_x", "cell_y", *(f"{p}{k}" for p in ("_l_", "_r_") for k in ("x0", "x1", "y0", "y1")))


def box_around(x: Column, y: Column, dx: float, dy: float) -> geom.Rect:
    return x - dx, x + dx, y - dy, y + dy


def nearest_join(points: DataFrame, segments: DataFrame, point: geom.Point, ends: tuple[geom.Point, geom.Point], keys: Sequence[str], ties: Sequence[str], reach: float, on: Sequence[str] = ()) -> DataFrame:
    """For each point the nearest segment within reach: keys, ties (its identity) and distance; of equal ones the first by ties.

    Only these few columns go into the aggregate, which keeps the least of each point before anything is shuffled.
    """
    _, _, away, _ = geom.closest(*ends, point)
    near = range_join(points, segments, box_around(*point, reach, reach), geom.bounds(*ends), 2 * reach, away <= reach, on).withColumn("distance", away)
    best = near.select(*keys, F.struct("distance", *ties).alias("_s")).groupBy(*keys).agg(F.min("_s").alias("_best"))
    return best.select(*keys, *(F.col(f"_best.{t}") for t in ties), F.col("_best.distance").alias("distance"))


def tolerant_match(reports: DataFrame, segments: DataFrame, directions: DataFrame, dx: float, dy: float, widen: float = 16.0) -> DataFrame:
    """Paths near each report: those of its route within (dx, dy), or within widen times that where there are none.

    Where the report's direction belongs to another route, that route's matches, found alike, are added. One join at the wide
    tolerance flags tight matches; flags are summed by report and path before any window. Columns: event_id, path_index.
    """
    own = reports.select("event_id", "lon", "lat", F.lit(0).alias("side"), "route_tag")
    other = reports.select("event_id", "lon", "lat", "dir_tag", F.col("route_tag").alias("own_route")).join(directions, "dir_tag").filter("route_tag <> own_route")
    asked = own.unionByName(other.select("event_id", "lon", "lat", F.lit(1).alias("side"), "route_tag"))
    c = F.col
    p, q = (c("lon1"), c("lat1")), (c("lon2"), c("lat2"))

    def within(k: float) -> Column:
        box = box_around(c("lon"), c("lat"), dx * k, dy * k)
        return geom.overlaps_open(box, geom.bounds(p, q)) & geom.clip_interval(p, q, box)[2]

    pairs = range_join(
        asked, segments.select("path_index", "route_tag", "lon1", "lat1", "lon2", "lat2"), box_around(c("lon"), c("lat"), dx * widen, dy * widen),
        geom.bounds(p, q), 2 * widen * max(dx, dy), within(widen), ["route_tag"],
    )
    found = pairs.groupBy("event_id", "side", "path_index").agg(F.bool_or(within(1.0)).alias("tight"))
    any_tight = F.bool_or("tight").over(Window.partitionBy("event_id", "side"))
    kept = found.withColumn("any_tight", any_tight).filter("tight OR NOT any_tight")
    return kept.select("event_id", "path_index").distinct()


def directed_segments(points: DataFrame, path: str = "path_index", position: str = "position") -> DataFrame:
    """Consecutive points (x, y) of each path as segments x1, y1, x2, y2 with length and the offset of their start."""
    w = Window.partitionBy(path).orderBy(position)
    seg = points.select(path, F.col(position).alias("seg_index"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.lead("x").over(w).alias("x2"), F.lead("y").over(w).alias("y2")).filter("x2 IS NOT NULL")
    seg = seg.withColumn("length", geom.length((F.col("x1"), F.col("y1")), (F.col("x2"), F.col("y2"))))
    before = Window.partitionBy(path).orderBy("seg_index").rowsBetween(Window.unboundedPreceding, -1)
    return seg.withColumn("start_offset", F.coalesce(F.sum("length").over(before), F.lit(0.0)))


def resegment(segments: DataFrame, target: float, path: str = "path_index") -> DataFrame:
    """Points at equal offsets: ceil(total / target) pieces; paths of fewer than two pieces have none.

    segments: path, seg_index, x1, y1, x2, y2, length, start_offset. Columns: path, position, x, y.
    """
    whole = Window.partitionBy(path)
    s = segments.withColumn("total", F.sum("length").over(whole)).withColumn("last", F.max("seg_index").over(whole))
    s = s.withColumn("pieces", F.ceil(F.col("total") / target)).filter("pieces >= 2").withColumn("piece", F.col("total") / F.col("pieces"))
    end = F.col("start_offset") + F.col("length")
    # A mark belongs to the segment that starts at it or before and ends after it; the path's last point to the last segment.
    lo, hi = F.ceil(F.col("start_offset") / F.col("piece")), F.ceil(end / F.col("piece")) - 1
    hi = F.when(F.col("seg_index") == F.col("last"), F.col("pieces")).otherwise(F.least(hi, F.col("pieces") - 1))
    marks = s.withColumn("lo", lo.cast("long")).withColumn("hi", hi.cast("long")).filter("hi >= lo").withColumn("position", F.explode(F.sequence("lo", "hi")))
    t = F.least(F.greatest((F.col("position") * F.col("piece") - F.col("start_offset")) / F.col("length"), F.lit(0.0)), F.lit(1.0))
    t = F.when(F.col("position") == F.col("pieces"), 1.0).otherwise(t)
    return marks.select(path, "position", (F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("y"))
