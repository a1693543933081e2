"""Lines through weighted points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def least_squares(df: DataFrame, keys: Sequence[str], x: Column, y: Column) -> DataFrame:
    """Ordinary least squares; a slope beyond 45 degrees makes x the dependent axis. Columns: keys, n, slope, intercept, y_dominant.

    Sums are centred by the aggregates themselves; without spread on the axis the line is null.
    """
    s = df.select(*keys, x.cast("double").alias("_x"), y.cast("double").alias("_y")).groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg("_x").alias("mx"), F.avg("_y").alias("my"), F.covar_pop("_x", "_y").alias("c"), F.var_pop("_x").alias("vx"), F.var_pop("_y").alias("vy")
    ).filter("n >= 2")
    flat = F.col("c") / F.nullif(F.col("vx"), F.lit(0.0))
    steep = F.coalesce(F.abs(flat) > 1, F.lit(True))
    slope = F.when(steep, F.col("c") / F.nullif(F.col("vy"), F.lit(0.0))).otherwise(flat)
    return s.select(*keys, "n", slope.alias("slope"), F.when(steep, F.col("mx") - slope * F.col("my")).otherwise(F.col("my") - slope * F.col("mx")).alias("intercept"), steep.alias("y_dominant"))


def orthogonal(m: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Line of the least squared orthogonal distances, from moments(): keys, n, x1, y1, x2, y2, one deviation either side of the mean.

    A slope within 45 degrees is taken as a function of x, else of y; points without any spread have no line.
    """
    b = F.col("x_var") - F.col("y_var")
    top, bottom = -b + F.sqrt(b * b + 4 * F.col("xy_cov") * F.col("xy_cov")), 2 * F.col("xy_cov")
    slope = top / F.nullif(bottom, F.lit(0.0))
    flat = F.coalesce(F.abs(slope) <= 1, F.lit(False))
    turned = bottom / F.nullif(top, F.lit(0.0))
    level = F.col("xy_cov") / F.nullif(F.col("x_var"), F.lit(0.0))
    sx, sy = F.sqrt("x_var"), F.sqrt("y_var")

    def at(k: int, axis: str) -> Column:
        dx, dy = k * sx, k * sy
        if axis == "x":
            return F.when(flat, F.col("x_mean") + dx).when(turned.isNotNull(), F.col("x_mean") + turned * dy).otherwise(F.when(level.isNotNull(), F.col("x_mean") + dx))
        return F.when(flat, F.col("y_mean") + slope * dx).when(turned.isNotNull(), F.col("y_mean") + dy).otherwise(F.col("y_mean") + level * dx)

    return m.filter("n >= 2").select(*keys, "n", at(-1, "x").alias("x1"), at(-1, "y").alias("y1"), at(1, "x").alias("x2"), at(1, "y").alias("y2")).filter("x1 IS NOT NULL")
