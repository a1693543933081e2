"""One- and two-dimensional statistics as aggregates and windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(x: Column) -> list[Column]:
    """count, min, max, mean and population variance and deviation of x, as aggregates."""
    return [
        F.count(x).alias("n"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
        F.var_pop(x).alias("variance"), F.stddev_pop(x).alias("stddev"),
    ]


def moments(df: DataFrame, keys: Sequence[str], x: Column, y: Column, w: Column, origin: tuple[Column, Column] | None = None) -> DataFrame:
    """Weighted means, variances and covariance: keys, n, w_sum, x_mean, y_mean, x_var, y_var, xy_cov.

    Sums are taken about an origin near the data (the first row's by default would need an order, so callers pass one),
    as the difference of large sums cancels; variances that rounding makes negative count as 0. One pass, partial sums first.
    """
    x0, y0 = origin or (F.lit(0.0), F.lit(0.0))
    d = df.select(*keys, w.alias("_w"), (x - x0).alias("_x"), (y - y0).alias("_y"), x0.alias("_x0"), y0.alias("_y0"))
    s = d.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum("_w").alias("w_sum"), F.sum(F.expr("_w * _x")).alias("sx"), F.sum(F.expr("_w * _y")).alias("sy"),
        F.sum(F.expr("_w * _x * _x")).alias("sxx"), F.sum(F.expr("_w * _y * _y")).alias("syy"), F.sum(F.expr("_w * _x * _y")).alias("sxy"),
        F.first("_x0").alias("x0"), F.first("_y0").alias("y0"),
    )
    per = lambda c: F.col(c) / F.nullif(F.col("w_sum"), F.lit(0.0))
    mx, my = per("sx"), per("sy")
    return s.select(
        *keys, "n", "w_sum", (mx + F.col("x0")).alias("x_mean"), (my + F.col("y0")).alias("y_mean"), F.greatest(per("sxx") - mx * mx, F.lit(0.0)).alias("x_var"),
        F.greatest(per("syy") - my * my, F.lit(0.0)).alias("y_var"), (per("sxy") - mx * my).alias("xy_cov"),
    )


def weighted_median(df: DataFrame, keys: Sequence[str], values: Sequence[str], weight: str) -> DataFrame:
    """Lower weighted median of each value: the first in order at which the cumulative weight reaches half.

    The values are stacked, so df is read once however many there are. Equal values are summed up first, so a group's window holds its
    distinct values only. Columns: keys, <value>_median.
    """
    stacked = df.select(*keys, F.col(weight).alias("_w"), F.explode(F.array(*(F.struct(F.lit(i).alias("_k"), F.col(v).cast("double").alias("_v")) for i, v in enumerate(values)))).alias("_s"))
    summed = stacked.groupBy(*keys, F.col("_s._k").alias("_k"), F.col("_s._v").alias("_v")).agg(F.sum("_w").alias("_w"))
    own = Window.partitionBy(*keys, "_k")
    cumulative = F.sum("_w").over(own.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = summed.withColumns({"_c": cumulative, "_t": F.sum("_w").over(own)}).filter("_c >= _t / 2")
    return marked.groupBy(*keys).agg(*(F.min(F.when(F.col("_k") == i, F.col("_v"))).alias(f"{v}_median") for i, v in enumerate(values)))


def sliding(order: Sequence[str], keys: Sequence[str], n: int):
    """The window of the last n rows."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), Window.currentRow)


def sliding_time(ms: str, keys: Sequence[str], length_ms: int):
    """The window of the last length_ms milliseconds, the row's own time included."""
    return Window.partitionBy(*keys).orderBy(ms).rangeBetween(-length_ms, Window.currentRow)


def order_violations(df: DataFrame, time: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows earlier than the last accepted row; a rejected row doesn't move that, so it is the running maximum."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("last_accepted", F.max(time).over(before)).filter(F.col("last_accepted") > F.col(time))


def trimmed_extrema(df: DataFrame, value: str, k: int) -> DataFrame:
    """Bounds without outliers: the mean of the values number k/2 to k from each end. Columns: low, high.

    Only the k smallest and largest rows are ordered: two top-k plans, no global window.
    """
    half = k // 2
    low = df.select(value).filter(F.col(value).isNotNull()).orderBy(value).limit(k).agg(F.sort_array(F.collect_list(value)).alias("v"))
    high = df.select(value).filter(F.col(value).isNotNull()).orderBy(F.desc(value)).limit(k).agg(F.sort_array(F.collect_list(value)).alias("w"))
    mean = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b, lambda a: a / half)
    return low.crossJoin(high).select(mean(F.slice("v", half + 1, half)).alias("low"), mean(F.slice("w", 1, half)).alias("high"))  # one row each


def samples_near_extrema(n: int) -> int:
    """How many samples from each end trimmed_extrema() looks at; too few samples are an error."""
    for least, k in ((1_000_000, 200), (100_000, 50), (10_000, 20)):
        if n >= least:
            return k
    raise ValueError(f"too few locations ({n}) to plan partitions")
