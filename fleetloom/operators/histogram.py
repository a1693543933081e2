"""Two-dimensional histograms as sparse cells, their intensity histograms and equalising palettes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geom import bucket


def histogram(df: DataFrame, x: Column, y: Column, low: tuple[float, float], extent: tuple[float, float], width: int, height: int) -> DataFrame:
    """hist_row, hist_col, hits of the cells with points; points out of range are left out."""
    col, row = bucket(x, F.lit(low[0]), F.lit(extent[0]), width), bucket(y, F.lit(low[1]), F.lit(extent[1]), height)
    # What lies far outside would overflow the bucket's integer.
    sane = x.between(low[0] - extent[0], low[0] + 2 * extent[0]) & y.between(low[1] - extent[1], low[1] + 2 * extent[1])
    cells = df.filter(sane).select(row.alias("hist_row"), col.alias("hist_col")).filter(F.col("hist_row").between(0, height - 1) & F.col("hist_col").between(0, width - 1))
    return cells.groupBy("hist_row", "hist_col").agg(F.count("*").alias("hits"))


def intensities(cells: DataFrame, slots: int) -> DataFrame:
    """intensity, occurrences: how many cells have each count, empty cells included."""
    full = cells.groupBy(F.col("hits").alias("intensity")).agg(F.count("*").alias("occurrences"))
    empty = full.agg((F.lit(slots) - F.coalesce(F.sum("occurrences"), F.lit(0))).alias("occurrences")).select(F.lit(0).cast("long").alias("intensity"), "occurrences")
    return full.union(empty.filter("occurrences > 0"))


def cumulative(counts: DataFrame) -> DataFrame:
    """With the running number of cells; there is a row for each distinct intensity, far fewer than cells."""
    return counts.withColumn("cdf", F.sum("occurrences").over(Window.orderBy("intensity").rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def palette(cdf: DataFrame) -> DataFrame:
    """With the equalised level, 0 to 255: floor((cdf - least) / (greatest - least) * 255 + 0.5)."""
    ends = cdf.agg(F.min("cdf").alias("lo"), F.max("cdf").alias("hi"))
    level = F.floor((F.col("cdf") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0)) * 255 + 0.5)
    return cdf.crossJoin(ends).select("intensity", "occurrences", "cdf", F.least(F.coalesce(level, F.lit(0)), F.lit(255)).cast("int").alias("level"))  # ends is one row


def image_row(row: Column, height: int) -> Column:
    """Row of a picture, whose first row is at the top."""
    return F.lit(height - 1) - row
