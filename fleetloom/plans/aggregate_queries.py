"""Queries of aggregates, windows, fits, histograms and the path refit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import fit, histogram, raster, refit, spatial, stats
from .fixtures import over_views, path_segments, table, vehicle_reports
from .join_queries import _NEAR, report_segments, waypoints
from .core import query

c = F.col


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("a01_exact_sum", "SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS VARCHAR) AS total, round(sum(l_extendedprice), 2) AS total_double FROM lineitem GROUP BY ALL")
def a01(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.sum(c("l_extendedprice").cast("decimal(18,2)")).cast("string").alias("total"), F.round(F.sum("l_extendedprice"), 2).alias("total_double"))


@query("a02_running_stats", "SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_quantity) AS min, max(l_quantity) AS max, round(avg(l_quantity), 6) AS mean, round(var_pop(l_quantity), 6) AS variance, round(stddev_pop(l_quantity), 6) AS stddev FROM lineitem GROUP BY ALL")
def a02(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(*stats.running(c("l_quantity"))), 6, "mean", "variance", "stddev")


@query("a03_weighted_moments", "SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 4) AS w_sum, round(sum(l_quantity * l_tax) / sum(l_quantity), 6) AS x_mean, round(sum(l_quantity * l_discount) / sum(l_quantity), 6) AS y_mean, round(sum(l_quantity * l_tax * l_tax) / sum(l_quantity) - power(sum(l_quantity * l_tax) / sum(l_quantity), 2), 8) AS x_var, round(sum(l_quantity * l_tax * l_discount) / sum(l_quantity) - sum(l_quantity * l_tax) / sum(l_quantity) * sum(l_quantity * l_discount) / sum(l_quantity), 8) + 0e0 AS xy_cov FROM lineitem GROUP BY ALL")
def a03(spark: SparkSession, d: str) -> DataFrame:
    m = stats.moments(table(spark, d, "lineitem"), ["l_suppkey"], c("l_tax"), c("l_discount"), c("l_quantity"))
    return m.select("l_suppkey", "n", F.round("w_sum", 4).alias("w_sum"), F.round("x_mean", 6).alias("x_mean"), F.round("y_mean", 6).alias("y_mean"), F.round("x_var", 8).alias("x_var"), (F.round("xy_cov", 8) + 0.0).alias("xy_cov"))


@query("a04_weighted_median", "SELECT l_suppkey, min(l_extendedprice) AS l_extendedprice_median FROM (SELECT *, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS cw, sum(l_quantity) OVER (PARTITION BY l_suppkey) AS tw FROM lineitem) WHERE cw >= tw / 2 GROUP BY l_suppkey")
def a04(spark: SparkSession, d: str) -> DataFrame:
    return stats.weighted_median(table(spark, d, "lineitem"), ["l_suppkey"], ["l_extendedprice"], "l_quantity")


@query("a05_vector_median", over_views("SELECT dir_tag, round(min(lon) FILTER (cx >= tw / 2), 6) AS lon_median, round(min(lat) FILTER (cy >= tw / 2), 6) AS lat_median FROM (SELECT *, sum(1e0) OVER (PARTITION BY dir_tag ORDER BY lon) AS cx, sum(1e0) OVER (PARTITION BY dir_tag ORDER BY lat) AS cy, sum(1e0) OVER (PARTITION BY dir_tag) AS tw FROM vehicle_reports) GROUP BY dir_tag"))
def a05(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).withColumn("w", F.lit(1.0))
    return _rounded(stats.weighted_median(r, ["dir_tag"], ["lon", "lat"], "w"), 6, "lon_median", "lat_median")


_MEDIAN = """w AS (SELECT path_index, seg_index, CASE WHEN distance * 1e5 <= 10 THEN 1e0 ELSE 1 / (distance * 1e5 - 9) END AS weight, round(cos(radians(CAST((450 - heading) % 360 AS DOUBLE))), 9) AS ux, round(sin(radians(CAST((450 - heading) % 360 AS DOUBLE))), 9) AS uy FROM near WHERE heading BETWEEN 0 AND 360),
cum AS (SELECT *, sum(weight) OVER (PARTITION BY path_index, seg_index ORDER BY ux) AS cx, sum(weight) OVER (PARTITION BY path_index, seg_index ORDER BY uy) AS cy, sum(weight) OVER (PARTITION BY path_index, seg_index) AS tw FROM w)"""


@query("a06_median_direction", over_views("SELECT path_index, seg_index, round(CASE WHEN a < 0 THEN a + 2 * pi() ELSE a END, 6) AS median_direction FROM (SELECT path_index, seg_index, atan2(min(uy) FILTER (cy >= tw / 2), min(ux) FILTER (cx >= tw / 2)) AS a FROM cum GROUP BY ALL)", _NEAR, _MEDIAN))
def a06(spark: SparkSession, d: str) -> DataFrame:
    near = report_segments(spark, d).filter("heading BETWEEN 0 AND 360")
    m = c("distance") * 1e5
    direction = geo.to_direction(c("heading"))
    near = near.select("path_index", "seg_index", F.when(m <= 10, 1.0).otherwise(1 / (m - 9)).alias("weight"), F.round(F.cos(direction), 9).alias("ux"), F.round(F.sin(direction), 9).alias("uy"))
    med = stats.weighted_median(near, ["path_index", "seg_index"], ["ux", "uy"], "weight")
    a = F.atan2("uy_median", "ux_median")
    return med.select("path_index", "seg_index", F.round(F.when(a < 0, a + 2 * 3.141592653589793).otherwise(a), 6).alias("median_direction"))


@query("a07_ols", "SELECT l_suppkey, n, round(CASE WHEN abs(m) <= 1 THEN m ELSE cv / vy END, 5) AS slope, round(CASE WHEN abs(m) <= 1 THEN my - m * mx ELSE mx - cv / vy * my END, 3) AS intercept, abs(m) > 1 AS y_dominant FROM (SELECT l_suppkey, count(*) AS n, covar_pop(l_quantity, l_extendedprice) AS cv, var_pop(l_quantity) AS vx, var_pop(l_extendedprice) AS vy, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, covar_pop(l_quantity, l_extendedprice) / var_pop(l_quantity) AS m FROM lineitem GROUP BY ALL) WHERE n >= 2")
def a07(spark: SparkSession, d: str) -> DataFrame:
    f = fit.least_squares(table(spark, d, "lineitem"), ["l_suppkey"], c("l_quantity"), c("l_extendedprice"))
    return f.select("l_suppkey", "n", F.round("slope", 5).alias("slope"), F.round("intercept", 3).alias("intercept"), "y_dominant")


_ORTHO = """m AS (SELECT path_index, count(*) AS n, avg(lon) AS mx, avg(lat) AS my, var_pop(lon) AS vx, var_pop(lat) AS vy, covar_pop(lon, lat) AS cv FROM near GROUP BY path_index),
s AS (SELECT *, (-(vx - vy) + sqrt((vx - vy) * (vx - vy) + 4 * cv * cv)) AS num, 2 * cv AS den FROM m)"""


@query("a08_orthogonal_fit", over_views("SELECT path_index, n, round(CASE WHEN abs(num / den) <= 1 THEN mx - sqrt(vx) ELSE mx - den / num * sqrt(vy) END, 5) AS x1, round(CASE WHEN abs(num / den) <= 1 THEN my - num / den * sqrt(vx) ELSE my - sqrt(vy) END, 5) AS y1, round(CASE WHEN abs(num / den) <= 1 THEN mx + sqrt(vx) ELSE mx + den / num * sqrt(vy) END, 5) AS x2, round(CASE WHEN abs(num / den) <= 1 THEN my + num / den * sqrt(vx) ELSE my + sqrt(vy) END, 5) AS y2 FROM s", _NEAR, _ORTHO))
def a08(spark: SparkSession, d: str) -> DataFrame:
    near = report_segments(spark, d)
    m = stats.moments(near, ["path_index"], c("lon"), c("lat"), F.lit(1.0), (F.lit(-71.05), F.lit(42.2)))
    return _rounded(fit.orthogonal(m, ["path_index"]), 5, "x1", "y1", "x2", "y2")


@query("a09_bounds", over_views("SELECT dir_tag, round(min(lon), 6) AS west, round(max(lon), 6) AS east, round(min(lat), 6) AS south, round(max(lat), 6) AS north FROM vehicle_reports GROUP BY ALL"))
def a09(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).groupBy("dir_tag").agg(F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north"))
    return _rounded(r, 6, "west", "east", "south", "north")


_HIST = "h AS (SELECT hist_row, hist_col, count(*) AS hits FROM (SELECT CAST(trunc((lat - 421e-1) / 45e-2 * 30) AS INT) AS hist_row, CAST(trunc((lon + 712e-1) / 4e-1 * 40) AS INT) AS hist_col FROM vehicle_reports) WHERE hist_row BETWEEN 0 AND 29 AND hist_col BETWEEN 0 AND 39 GROUP BY ALL)"
_COUNTS = "i AS (SELECT intensity, count(*) AS occurrences FROM (SELECT coalesce(hits, 0) AS intensity FROM (SELECT a.range AS y, b.range AS x FROM range(30) a, range(40) b) g LEFT JOIN h ON h.hist_row = g.y AND h.hist_col = g.x) GROUP BY ALL), cum AS (SELECT *, CAST(sum(occurrences) OVER (ORDER BY intensity) AS BIGINT) AS cdf FROM i)"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return histogram.histogram(vehicle_reports(spark, d), c("lon"), c("lat"), (-71.2, 42.1), (0.4, 0.45), 40, 30)


@query("a10_hist2d", over_views("SELECT hist_row, hist_col, hits FROM h", _HIST))
def a10(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d)


@query("a11_intensity", over_views("SELECT intensity, occurrences FROM i", _HIST, _COUNTS))
def a11(spark: SparkSession, d: str) -> DataFrame:
    return histogram.intensities(_cells(spark, d), 1200)


@query("a12_cdf_palette", over_views("SELECT intensity, occurrences, cdf, CAST(least(255, floor(CAST(cdf - (SELECT min(cdf) FROM cum) AS DOUBLE) / (SELECT max(cdf) - min(cdf) FROM cum) * 255 + 5e-1)) AS INT) AS level FROM cum", _HIST, _COUNTS))
def a12(spark: SparkSession, d: str) -> DataFrame:
    return histogram.palette(histogram.cumulative(histogram.intensities(_cells(spark, d), 1200)))


@query("a13_trusted_dirs", over_views("SELECT path_index, dir_tag, count(*) AS reports, round(avg(angle), 5) AS mean_angle, avg(angle) < pi() / 4 AS trusted FROM (SELECT *, row_number() OVER (PARTITION BY path_index, event_id ORDER BY distance, seg_index) AS k FROM near WHERE perpendicular AND angle IS NOT NULL) WHERE k = 1 GROUP BY ALL", _NEAR))
def a13(spark: SparkSession, d: str) -> DataFrame:
    near = report_segments(spark, d).withColumnRenamed("event_id", "report_id")
    return refit.trusted_tags(near).select("path_index", "dir_tag", "reports", F.round("mean_angle", 5).alias("mean_angle"), "trusted")


@query("a14_near_counts", over_views("SELECT path_index, seg_index, count(*) AS reports, count(*) >= 50 AS many FROM near GROUP BY ALL", _NEAR))
def a14(spark: SparkSession, d: str) -> DataFrame:
    return report_segments(spark, d).groupBy("path_index", "seg_index").agg(F.count("*").alias("reports")).withColumn("many", c("reports") >= refit.MANY)


# Two prices of each line: a table that is large enough at every scale, and whose count decides how many are looked at.
_PRICES = "p AS (SELECT l_extendedprice AS p FROM lineitem UNION ALL SELECT l_extendedprice * 125e-2 FROM lineitem)"


@query(
    "a15_trimmed_extrema",
    f"""WITH {_PRICES}, k AS (SELECT count(*) AS n, CASE WHEN count(*) >= 1000000 THEN 200 WHEN count(*) >= 100000 THEN 50 WHEN count(*) >= 10000 THEN 20 END AS k FROM p)
    SELECT any_value(n) AS n, round(avg(p) FILTER (a > k // 2 AND a <= k), 6) AS low, round(avg(p) FILTER (b > k // 2 AND b <= k), 6) AS high, round(avg(p), 4) AS mean
    FROM (SELECT p, row_number() OVER (ORDER BY p) AS a, row_number() OVER (ORDER BY p DESC) AS b FROM p), k""",
)
def a15(spark: SparkSession, d: str) -> DataFrame:
    prices = table(spark, d, "lineitem").select(F.explode(F.array(c("l_extendedprice").cast("double"), c("l_extendedprice").cast("double") * 1.25)).alias("p"))
    whole = prices.agg(F.count("*").alias("n"), F.avg("p").alias("mean"))
    bounds = stats.trimmed_extrema(prices, "p", stats.samples_near_extrema(prices.count()))
    return _rounded(_rounded(whole.crossJoin(bounds), 6, "low", "high"), 4, "mean")  # one row each


@query("a16_mean_time", over_views("SELECT vehicle_id, count(*) AS n, CAST(floor(avg(unix_ms % 100000) + 5e-1) AS BIGINT) AS mean_ms FROM vehicle_reports GROUP BY ALL"))
def a16(spark: SparkSession, d: str) -> DataFrame:
    return vehicle_reports(spark, d).groupBy("vehicle_id").agg(F.count("*").alias("n"), F.floor(F.avg(c("unix_ms") % 100000) + 0.5).cast("long").alias("mean_ms"))


@query("a17_dedup_paths", over_views("SELECT row_number() OVER (ORDER BY first_path) AS dense_index, first_path, copies FROM (SELECT min(path_index) AS first_path, count(*) AS copies FROM (SELECT path_index, string_agg(CAST(round((lat1 - 421e-1 - (path_index % 8) * 5e-2) * 1e4) AS INT), ',' ORDER BY seg_index) AS shape FROM path_segments GROUP BY path_index) GROUP BY shape)"))
def a17(spark: SparkSession, d: str) -> DataFrame:
    y = F.round((c("lat1") - 42.1 - (c("path_index") % 8) * 0.05) * 1e4).cast("int")
    shapes = path_segments(spark).groupBy("path_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("seg_index", y.alias("y")))), lambda s: s["y"]).alias("shape"))
    first = shapes.groupBy("shape").agg(F.min("path_index").alias("first_path"), F.count("*").alias("copies"))
    # The catalogue of distinct paths is small; its dense index needs one order.
    return first.select(F.row_number().over(Window.orderBy("first_path")).cast("long").alias("dense_index"), "first_path", "copies")


@query("a18_catalogue_counts", over_views("SELECT (SELECT count(*) FROM path_segments) AS segments, (SELECT count(DISTINCT path_index) FROM path_segments) AS paths, (SELECT count(DISTINCT route_tag) FROM path_segments) AS routes, (SELECT count(*) FROM directions) AS directions"))
def a18(spark: SparkSession, d: str) -> DataFrame:
    from .fixtures import directions

    s = path_segments(spark).agg(F.count("*").alias("segments"), F.count_distinct("path_index").alias("paths"), F.count_distinct("route_tag").alias("routes"))
    return s.crossJoin(directions(spark).agg(F.count("*").alias("directions")))


@query("w01_sliding", "SELECT o_orderkey, round(avg(o_totalprice) OVER w, 4) AS mean, count(*) OVER w AS n, round(min(o_totalprice) OVER w, 2) AS lo FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")
def w01(spark: SparkSession, d: str) -> DataFrame:
    w = stats.sliding(["o_orderdate", "o_orderkey"], ["o_custkey"], 5)
    return table(spark, d, "orders").select("o_orderkey", F.round(F.avg("o_totalprice").over(w), 4).alias("mean"), F.count("*").over(w).alias("n"), F.round(F.min("o_totalprice").over(w), 2).alias("lo"))


@query("w01_sliding_time", over_views("SELECT event_id, count(*) OVER w AS n, round(avg(heading) OVER w, 5) AS mean FROM vehicle_reports WINDOW w AS (PARTITION BY vehicle_id ORDER BY unix_ms RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW)"))
def w01_time(spark: SparkSession, d: str) -> DataFrame:
    w = stats.sliding_time("unix_ms", ["vehicle_id"], 86_400_000)
    return vehicle_reports(spark, d).select("event_id", F.count("*").over(w).alias("n"), F.round(F.avg("heading").over(w), 5).alias("mean"))


@query("w02_cumulative", "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running FROM orders")
def w02(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table(spark, d, "orders").select("o_orderkey", F.round(F.sum("o_totalprice").over(w), 2).alias("running"))


@query("w03_adjacent", over_views("SELECT event_id, unix_ms - lag(unix_ms) OVER w AS gap_ms, lead(dir_tag) OVER w AS next_dir FROM vehicle_reports WINDOW w AS (PARTITION BY vehicle_id ORDER BY unix_ms, event_id)"))
def w03(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("vehicle_id").orderBy("unix_ms", "event_id")
    return vehicle_reports(spark, d).select("event_id", (c("unix_ms") - F.lag("unix_ms").over(w)).alias("gap_ms"), F.lead("dir_tag").over(w).alias("next_dir"))


@query("z13_clock_drift", over_views("SELECT event_id, CASE WHEN isnan(m) THEN NULL ELSE round(m, 5) END AS drift FROM (SELECT event_id, regr_slope(y, x) OVER w AS m FROM (SELECT event_id, vehicle_id, unix_ms, CAST(unix_ms % 100000 AS DOUBLE) AS x, CAST(unix_ms % 100000 AS DOUBLE) * 3 + event_id % 7 AS y FROM vehicle_reports) WINDOW w AS (PARTITION BY vehicle_id ORDER BY unix_ms, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"))
def z13(spark: SparkSession, d: str) -> DataFrame:
    r = vehicle_reports(spark, d).withColumn("x", (c("unix_ms") % 100000).cast("double")).withColumn("y", c("x") * 3 + c("event_id") % 7)
    w = stats.sliding(["unix_ms", "event_id"], ["vehicle_id"], 10)
    return r.select("event_id", F.round(F.regr_slope("y", "x").over(w), 5).alias("drift"))


def planar_reports(spark: SparkSession, d: str) -> DataFrame:
    """Reports in thousandths of a degree about the south-west corner, with directions."""
    r = vehicle_reports(spark, d)
    return r.select(c("event_id").alias("report_id"), ((c("lon") + 71.2) * 1000).alias("x"), ((c("lat") - 42.1) * 1000).alias("y"), geo.to_direction(c("heading")).alias("direction"), "dir_tag")


def planar_waypoints(spark: SparkSession) -> DataFrame:
    return waypoints(spark).select("path_index", "position", ((c("x") + 71.2) * 1000).alias("x"), ((c("y") - 42.1) * 1000).alias("y"))


@query("i01_refit_round")
def i01(spark: SparkSession, d: str) -> DataFrame:
    segments = spatial.directed_segments(planar_waypoints(spark))
    return _rounded(refit.fit_round(planar_reports(spark, d), segments, 4.0), 5, "x1", "y1", "x2", "y2")


@query("i02_rebuild")
def i02(spark: SparkSession, d: str) -> DataFrame:
    segments = spatial.directed_segments(planar_waypoints(spark))
    return _rounded(refit.rebuild(segments, refit.fit_round(planar_reports(spark, d), segments, 4.0)), 5, "x", "y")


_WEIGHTED = """wm0 AS (SELECT path_index, (1 - least(pi() / 2, angle) / (pi() / 2)) * least(1, 1 / greatest(distance * 1e3, 1e-9)) AS w, lon, lat FROM near WHERE angle IS NOT NULL),
wm AS (SELECT path_index, count(*) AS n, sum(w) AS sw, sum(w * (lon + 7105e-2)) / sum(w) AS ax, sum(w * (lat - 422e-1)) / sum(w) AS ay, sum(w * power(lon + 7105e-2, 2)) / sum(w) AS qx, sum(w * power(lat - 422e-1, 2)) / sum(w) AS qy,
    sum(w * (lon + 7105e-2) * (lat - 422e-1)) / sum(w) AS qxy FROM wm0 GROUP BY path_index),
ws AS (SELECT path_index, n, sw, ax - 7105e-2 AS mx, ay + 422e-1 AS my, qx - ax * ax AS vx, qy - ay * ay AS vy, 2 * (qxy - ax * ay) AS den, -(qx - ax * ax - qy + ay * ay) + sqrt(power(qx - ax * ax - qy + ay * ay, 2) + 4 * power(qxy - ax * ay, 2)) AS num FROM wm)"""


@query("i03_weighted_fit", over_views("SELECT path_index, n, round(CASE WHEN abs(num / den) <= 1 THEN mx - sqrt(vx) ELSE mx - den / num * sqrt(vy) END, 5) AS x1, round(CASE WHEN abs(num / den) <= 1 THEN my - num / den * sqrt(vx) ELSE my - sqrt(vy) END, 5) AS y1 FROM ws", _NEAR, _WEIGHTED))
def i03(spark: SparkSession, d: str) -> DataFrame:
    near = report_segments(spark, d).filter("angle IS NOT NULL")
    weight = (1 - F.least(F.lit(refit.HALF), c("angle")) / refit.HALF) * F.least(F.lit(1.0), 1 / F.greatest(c("distance") * 1e3, F.lit(1e-9)))
    m = stats.moments(near, ["path_index"], c("lon"), c("lat"), weight, (F.lit(-71.05), F.lit(42.2)))
    return _rounded(fit.orthogonal(m, ["path_index"]).select("path_index", "n", "x1", "y1"), 5, "x1", "y1")


@query("k12_line_cells", over_views("SELECT path_index, CAST(floor((2 * r1 * n + 2 * i * (r2 - r1) + n) / (2e0 * n)) AS BIGINT) AS pic_row, CAST(floor((2 * c1 * n + 2 * i * (c2 - c1) + n) / (2e0 * n)) AS BIGINT) AS pic_col, count(*) AS hits FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM (SELECT *, greatest(abs(c2 - c1), abs(r2 - r1)) AS n FROM px)) GROUP BY ALL", "px AS (SELECT path_index, seg_index * 8 AS c1, (path_index * 3 + seg_index * 5) % 11 AS r1, seg_index * 8 + 8 AS c2, (path_index * 3 + seg_index * 5 + 5) % 11 AS r2 FROM path_segments)"))
def k12(spark: SparkSession, d: str) -> DataFrame:
    y = lambda k: (c("path_index") * 3 + c("seg_index") * 5 + k) % 11
    cells = raster.line_cells(path_segments(spark), c("seg_index") * 8, y(0), c("seg_index") * 8 + 8, y(5))
    return cells.groupBy("path_index", "pic_row", "pic_col").agg(F.count("*").alias("hits"))
