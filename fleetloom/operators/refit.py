"""Refitting paths to observed traffic: one plan over all paths, a few rounds from the driver."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom
from . import fit, lineage, spatial, stats

c = F.col
HALF = math.pi / 2


def _p() -> geom.Point:
    return c("x1"), c("y1")


def _q() -> geom.Point:
    return c("x2"), c("y2")


def _at() -> geom.Point:
    return c("x"), c("y")

#: Reports near a segment from which on those beside its ends count less; the angle below which a dir tag is trusted.
MANY, TRUSTED = 50, math.pi / 4


def links(reports: DataFrame, segments: DataFrame, reach: float) -> DataFrame:
    """Reports (report_id, x, y, direction, dir_tag) beside segments (path_index, seg_index, x1, y1, x2, y2) within reach of their box."""
    nx, ny, away, perpendicular = geom.closest(_p(), _q(), _at())
    pairs = spatial.range_join(reports, segments, spatial.box_around(*_at(), reach, reach), geom.bounds(_p(), _q()), 2 * reach, F.lit(True))
    seg_direction = geom.direction(_p(), _q())
    return pairs.withColumns({"nx": nx, "ny": ny, "distance": away, "perpendicular": perpendicular, "seg_direction": seg_direction, "angle": geom.angle_between(c("direction"), seg_direction)})


def trusted_tags(near: DataFrame) -> DataFrame:
    """path_index, dir_tag, mean_angle, trusted: from each report's nearest segment whose perpendicular meets it."""
    best = near.filter("perpendicular AND angle IS NOT NULL").groupBy("path_index", "report_id").agg(F.min_by(F.struct("dir_tag", "angle"), F.struct("distance", "seg_index")).alias("b"))
    return best.groupBy("path_index", c("b.dir_tag").alias("dir_tag")).agg(F.avg("b.angle").alias("mean_angle"), F.count("*").alias("reports")).withColumn("trusted", c("mean_angle") < TRUSTED)


def median_directions(near: DataFrame, weight: str = "weight") -> DataFrame:
    """path_index, seg_index, median_direction: of the weighted medians of the directions' two components."""
    d = near.filter(f"{weight} > 0 AND direction IS NOT NULL").select("path_index", "seg_index", weight, F.cos("direction").alias("ux"), F.sin("direction").alias("uy"))
    m = stats.weighted_median(d, ["path_index", "seg_index"], ["ux", "uy"], weight)
    return m.select("path_index", "seg_index", geom.normalised(F.atan2("uy_median", "ux_median")).alias("median_direction"))


def _end_weights(near: DataFrame) -> DataFrame:
    """First pass: trusted tags within reach; half for those beside an end where reports are many, half again at the path's ends."""
    own = Window.partitionBy("path_index", "seg_index")
    n = near.withColumn("many", F.count("*").over(own) >= MANY)
    beside = ~c("perpendicular")
    w = F.when(c("trusted") & (c("distance") <= c("reach")), F.lit(1.0) * F.when(beside & c("many"), 0.5).otherwise(1.0) * F.when(beside & ((c("seg_index") == 0) | (c("seg_index") == c("last_index"))), 0.5).otherwise(1.0)).otherwise(0.0)
    return n.withColumn("weight", w)


def _fit_weight() -> Column:
    """Second pass: direction and distance."""
    trust = geom.angle_between(c("median_direction"), c("seg_direction")) < math.pi / 8
    outside = trust & (((c("seg_index") == 0) & (c("nx") == c("x1")) & (c("ny") == c("y1"))) | ((c("seg_index") == c("last_index")) & (c("nx") == c("x2")) & (c("ny") == c("y2"))))
    turn = geom.angle_between(c("median_direction"), c("direction"))
    by_turn = F.when(c("direction").isNull(), 1.0).when(turn >= HALF, 0.0).otherwise(1 - turn / HALF * 0.3)
    by_distance = F.when(c("distance") > c("reach"), 0.0).otherwise(1 - c("distance") / c("reach") * 0.3)
    return F.when(outside, 0.0).otherwise(by_turn * by_distance * F.when(trust & ~c("perpendicular"), 0.5).otherwise(1.0))


def fit_round(reports: DataFrame, segments: DataFrame, reach: float) -> DataFrame:
    """path_index, seg_index, n, x1, y1, x2, y2: a line for each segment with near reports."""
    last = segments.groupBy("path_index").agg(F.max("seg_index").alias("last_index"))
    # Read by three aggregates and by the fit; the spatial join runs once.
    near = lineage.cut(links(reports, segments.join(last, "path_index"), reach).withColumn("reach", F.lit(float(reach))))
    tags = trusted_tags(near).select("path_index", "dir_tag", "trusted")
    near = _end_weights(near.join(tags, ["path_index", "dir_tag"], "left").fillna(False, ["trusted"]))
    near = near.join(median_directions(near), ["path_index", "seg_index"], "left")
    near = near.withColumn("median_direction", F.coalesce("median_direction", "seg_direction")).withColumn("fit_weight", _fit_weight())
    m = stats.moments(near, ["path_index", "seg_index"], c("x"), c("y"), c("fit_weight"), ((c("x1") + c("x2")) / 2, (c("y1") + c("y2")) / 2))
    return fit.orthogonal(m.filter("w_sum > 0"), ["path_index", "seg_index"])


def rebuild(segments: DataFrame, lines: DataFrame) -> DataFrame:
    """New waypoints (path_index, position, x, y): ends are moved onto their lines, inner ones are where neighbouring lines meet.

    Segments without a line vanish and so do meetings of parallel lines; positions are numbered anew.
    """
    fitted = segments.select("path_index", "seg_index", *(c(k).alias(f"s_{k}") for k in ("x1", "y1", "x2", "y2"))).join(lines, ["path_index", "seg_index"])
    w = Window.partitionBy("path_index").orderBy("seg_index")
    f = fitted.select("*", F.row_number().over(w).alias("k"), *(F.lead(k).over(w).alias(f"n_{k}") for k in ("x1", "y1", "x2", "y2")))
    start = geom.nearest_on_line(_p(), _q(), (c("s_x1"), c("s_y1")))
    stop = geom.nearest_on_line(_p(), _q(), (c("s_x2"), c("s_y2")))
    meet = geom.intersection(_p(), _q(), (c("n_x1"), c("n_y1")), (c("n_x2"), c("n_y2")))
    first = F.when(c("k") == 1, F.array(F.struct(F.lit(0).alias("o"), start[0].alias("x"), start[1].alias("y")))).otherwise(F.array().cast("array<struct<o:int,x:double,y:double>>"))
    after = F.when(c("n_x1").isNull(), F.struct(F.lit(2).alias("o"), stop[0].alias("x"), stop[1].alias("y"))).otherwise(F.struct(F.lit(1).alias("o"), meet[0].alias("x"), meet[1].alias("y")))
    points = f.select("path_index", "k", F.explode(F.concat(first, F.array(after))).alias("pt")).filter("pt.x IS NOT NULL")
    numbered = F.row_number().over(Window.partitionBy("path_index").orderBy("k", "pt.o")) - 1
    return points.select("path_index", numbered.cast("long").alias("position"), "pt.x", "pt.y")


def refit(reports: DataFrame, waypoints: DataFrame, reach: float, rounds: int = 5) -> DataFrame:
    """Waypoints after some rounds; each round is checkpointed, which cuts the lineage and survives lost executors."""
    for _ in range(rounds):
        segments = spatial.directed_segments(waypoints)
        waypoints = rebuild(segments, fit_round(reports, segments, reach))
        waypoints = lineage.cut(waypoints)
    return waypoints
