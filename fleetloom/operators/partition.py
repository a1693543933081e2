"""Adaptive spatial partitioning: plan leaves over counts, route rows to leaves, prune leaves by region.

A plan is a small list of leaves (leaf, x0, x1, y0, y1); lower edges belong to a leaf, upper ones don't, outermost
edges are infinite. Planners look at a bounded sample or at one count for each cell; rows never reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo
from . import stats

INF = float("inf")
_SCHEMA = "leaf int, x0 double, x1 double, y0 double, y1 double"


@dataclass(frozen=True)
class Box:
    x0: float
    x1: float
    y0: float
    y1: float


def leaf_index(spark: SparkSession, boxes: list[Box]) -> DataFrame:
    return spark.createDataFrame([(i, b.x0, b.x1, b.y0, b.y1) for i, b in enumerate(boxes)], _SCHEMA)


def grid_leaves(spark: SparkSession, cuts_x: list[float], cuts_y: list[float]) -> DataFrame:
    """Leaves between sorted cuts, row by row from the south."""
    xs, ys = [-INF, *cuts_x, INF], [-INF, *cuts_y, INF]
    return leaf_index(spark, [Box(a, b, p, q) for p, q in zip(ys, ys[1:], strict=False) for a, b in zip(xs, xs[1:], strict=False)])


def _decide(boxes: list[tuple[int, Box]], x: Column, y: Column) -> Column:
    """The leaf of a point as a decision tree: at each node the most even cut that no box straddles."""

    def within(b: Box) -> Column:
        test = F.lit(True)
        for v, lo, hi in ((x, b.x0, b.x1), (y, b.y0, b.y1)):
            test = test & (v >= lo if lo > -INF else F.lit(True)) & (v < hi if hi < INF else F.lit(True))
        return test

    if len(boxes) > 2:
        best = None
        for axis, low, high in (("x", "x0", "x1"), ("y", "y0", "y1")):
            for cut in {getattr(b, low) for _, b in boxes} - {-INF}:
                left = [e for e in boxes if getattr(e[1], high) <= cut]
                if left and len(left) < len(boxes) and all(getattr(b, low) >= cut or getattr(b, high) <= cut for _, b in boxes):
                    found = (max(len(left), len(boxes) - len(left)), axis, cut, left)
                    best = found if best is None or found[:3] < best[:3] else best
        if best:
            _, axis, cut, left = best
            right = [e for e in boxes if e not in left]
            return F.when((x if axis == "x" else y) < cut, _decide(left, x, y)).otherwise(_decide(right, x, y))
    expr = F.lit(None).cast("int")
    for leaf, b in boxes:
        expr = F.when(within(b), leaf).otherwise(expr)
    return expr


#: Leaves up to which a plan is one expression; larger plans meet the rows by grid cells.
FEW = 64


def _finite(b: Box) -> bool:
    return all(abs(v) < INF for v in (b.x0, b.x1, b.y0, b.y1))


def _cells(spark: SparkSession, boxes: list[tuple[int, Box]]) -> tuple[DataFrame, Box, float, float]:
    """_cx, _cy, _leaf, its edges for each cell of a grid that a leaf touches; the grid's region and cell sides. At most about nine rows for each leaf."""
    whole = Box(min(b.x0 for _, b in boxes), max(b.x1 for _, b in boxes), min(b.y0 for _, b in boxes), max(b.y1 for _, b in boxes))
    n = 2 * math.isqrt(len(boxes)) + 1
    w, h = (whole.x1 - whole.x0) / n, (whole.y1 - whole.y0) / n
    leaves = spark.createDataFrame([(leaf, b.x0, b.x1, b.y0, b.y1) for leaf, b in boxes], "_leaf int, _x0 double, _x1 double, _y0 double, _y1 double")
    span = lambda lo, hi, start, side: F.explode(F.sequence(F.floor((F.col(lo) - start) / side), F.floor((F.col(hi) - start) / side)))
    return leaves.withColumn("_cx", span("_x0", "_x1", whole.x0, w)).withColumn("_cy", span("_y0", "_y1", whole.y0, h)), whole, w, h


def route(df: DataFrame, leaves: DataFrame, x: Column, y: Column) -> DataFrame:
    """df with `leaf`, null where no leaf holds the point. The plan is collected: its leaves are few beside any table's rows.

    A small plan becomes one expression, as deep as the logarithm of its size; of a large one the finite leaves are joined by the grid cell of the
    point, which is a broadcast of some rows for each leaf, and the open outer leaves stay an expression.
    """
    boxes = [(r.leaf, Box(r.x0, r.x1, r.y0, r.y1)) for r in leaves.collect()]
    if len(boxes) <= FEW:
        return df.withColumn("leaf", _decide(boxes, x, y))
    inner, outer = [e for e in boxes if _finite(e[1])], [e for e in boxes if not _finite(e[1])]
    if len(outer) > FEW:
        raise ValueError(f"a plan has {FEW} open leaves at most, not {len(outer)}")
    cells, whole, w, h = _cells(df.sparkSession, inner)
    placed = df.withColumns({"_px": x, "_py": y}).withColumns({"_cx": F.floor((F.col("_px") - whole.x0) / w), "_cy": F.floor((F.col("_py") - whole.y0) / h)})
    inside = (F.col("_px") >= F.col("_x0")) & (F.col("_px") < F.col("_x1")) & (F.col("_py") >= F.col("_y0")) & (F.col("_py") < F.col("_y1"))
    met = placed.alias("p").join(F.broadcast(cells.alias("q")), (F.col("p._cx") == F.col("q._cx")) & (F.col("p._cy") == F.col("q._cy")) & inside, "left")
    leaf = F.coalesce(F.col("_leaf"), _decide(outer, F.col("_px"), F.col("_py"))) if outer else F.col("_leaf")
    return met.select(*(F.col(f"p.`{c}`") for c in df.columns), leaf.alias("leaf"))


def overlapping(leaves: DataFrame, region: tuple[float, float, float, float]) -> list[int]:
    """Numbers of the leaves that a region (x0, x1, y0, y1) touches, edges included: what a scan of leaf files has to read."""
    x0, x1, y0, y1 = region
    return sorted(r.leaf for r in leaves.filter((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0)).select("leaf").collect())


def write_leaves(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A directory for each leaf; rows of a leaf are spread over as many files as their number asks for."""
    df.hint("rebalance", "leaf").write.mode(mode).partitionBy("leaf").parquet(path)


def with_outside(boxes: list[Box], region: Box) -> list[Box]:
    """The leaves and four outer ones, so that every point has a leaf."""
    return [*boxes, Box(-INF, INF, -INF, region.y0), Box(-INF, INF, region.y1, INF), Box(-INF, region.x0, region.y0, region.y1), Box(region.x1, INF, region.y0, region.y1)]


def write_plan(leaves: DataFrame, path: str) -> None:
    """A plan as lines of JSON; open edges are spelled out."""
    leaves.select("leaf", *(F.col(c).cast("string").alias(c) for c in ("x0", "x1", "y0", "y1"))).coalesce(1).write.json(path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """What write_plan() wrote."""
    rows = spark.read.schema("leaf int, x0 string, x1 string, y0 string, y1 string").json(path)
    return rows.select("leaf", *(F.col(c).cast("double").alias(c) for c in ("x0", "x1", "y0", "y1")))


def trimmed_region(sample: DataFrame, x: str, y: str) -> Box:
    """The sample's bounds without its outliers: means of values near each end (see stats.trimmed_extrema); fewer than 10,000 rows are an error."""
    k = stats.samples_near_extrema(sample.count())
    bx, by = stats.trimmed_extrema(sample, x, k).first(), stats.trimmed_extrema(sample, y, k).first()
    return Box(bx.low, bx.high, by.low, by.high)


def _measured(spark: SparkSession, boxes: list[Box]) -> list[tuple[float, float]]:
    """Metres from south to north and from west to east along the central axes of boxes in degrees (x is longitude)."""
    south, north, west, east = F.col("y0"), F.col("y1"), F.col("x0"), F.col("x1")
    mid = (south + north) / 2
    sizes = leaf_index(spark, boxes).select("leaf", geo.distance(south, F.lit(0.0), north, F.lit(0.0)).alias("sn"), geo.distance(mid, west, mid, east).alias("we"))
    return [(r.sn, r.we) for r in sorted(sizes.collect(), key=lambda r: r.leaf)]


def _ranked(placed: DataFrame, wide: dict[int, bool], x: str, y: str, cuts: int) -> dict[int, list[float]]:
    """For each leaf the coordinates at which cuts + 1 slices begin whose counts differ by one at most, in the order of the leaf's longer axis."""
    along = F.create_map(*(F.lit(v) for e in wide.items() for v in e))[F.col("leaf")]
    own = Window.partitionBy("leaf")
    rows = placed.filter(F.col("leaf").isin(list(wide))).select("leaf", F.when(along, F.col(x)).otherwise(F.col(y)).alias("v"))
    rows = rows.select("leaf", "v", (F.row_number().over(own.orderBy("v")) - 1).alias("i"), F.count("*").over(own).alias("n"))
    # Slice sizes are the remaining rows over the remaining slices, rounded down, so the k-th begins here.
    starts, at = [], F.lit(0)
    for left in range(cuts + 1, 1, -1):
        at = at + F.floor((F.col("n") - at) / left)
        starts.append(at.cast("long"))
    found = rows.filter(F.array_contains(F.array(*starts), F.col("i").cast("long"))).groupBy("leaf").agg(F.sort_array(F.collect_list("v")).alias("v"))
    return {r.leaf: list(r.v) for r in found.collect()}


def equal_count_leaves(spark: SparkSession, sample: DataFrame, x: str, y: str, cuts: int = 2, levels: int = 6, least_side: float = 500.0) -> DataFrame:
    """Leaves of about equal counts over a sample in degrees (x is longitude).

    The two outermost levels set apart what lies beyond the trimmed bounds of the longer axis, then of the other one, among what is left. Each
    further level cuts the longer axis of each leaf into cuts + 1 slices of equal counts, until levels are used up or its longer side is no
    more than least_side metres. Each level is one window over the sample, which is bounded by its maker; fewer than a hundred rows for each
    leaf are an error. A slice begins at a row's coordinate; rows that share it go with it.
    """
    n, slices = sample.count(), (cuts + 1) ** (levels - 2)
    if n < (slices + 4) * 100:
        raise ValueError(f"too few locations ({n}) for {slices + 4} leaves")
    bounds = trimmed_region(sample, x, y)
    middle = sample.agg(F.percentile_approx(x, 0.5, 100_000).alias("x"), F.percentile_approx(y, 0.5, 100_000).alias("y")).first()
    (sn, _), (_, we) = _measured(spark, [Box(middle.x, middle.x, bounds.y0, bounds.y1), Box(bounds.x0, bounds.x1, middle.y, middle.y)])
    wide_first = we >= sn
    kept = sample.filter(F.col(x).between(bounds.x0, bounds.x1) if wide_first else F.col(y).between(bounds.y0, bounds.y1))
    inner = trimmed_region(kept, x, y)
    region = Box(bounds.x0, bounds.x1, inner.y0, inner.y1) if wide_first else Box(inner.x0, inner.x1, bounds.y0, bounds.y1)
    kept = kept.filter(F.col(x).between(region.x0, region.x1) & F.col(y).between(region.y0, region.y1))
    boxes = [region]
    for _ in range(levels - 2):
        sizes = _measured(spark, boxes)
        wide = {i: we >= sn for i, (sn, we) in enumerate(sizes) if max(sn, we) > least_side}
        if not wide:
            break
        # For counting, the outer slices take in the region's last edge.
        open_ = [Box(b.x0, INF if b.x1 == region.x1 else b.x1, b.y0, INF if b.y1 == region.y1 else b.y1) for b in boxes]
        found = _ranked(route(kept, leaf_index(spark, open_), F.col(x), F.col(y)), wide, x, y, cuts)
        after: list[Box] = []
        for i, b in enumerate(boxes):
            if i not in wide:
                after.append(b)
                continue
            lo, hi = (b.x0, b.x1) if wide[i] else (b.y0, b.y1)
            edges = [lo, *sorted({v for v in found.get(i, ()) if lo < v < hi}), hi]
            after += [Box(p, q, b.y0, b.y1) if wide[i] else Box(b.x0, b.x1, p, q) for p, q in zip(edges, edges[1:], strict=False)]
        boxes = after
    if wide_first:
        outer = [Box(-INF, region.x0, -INF, INF), Box(region.x1, INF, -INF, INF), Box(region.x0, region.x1, -INF, region.y0), Box(region.x0, region.x1, region.y1, INF)]
    else:
        outer = [Box(-INF, INF, -INF, region.y0), Box(-INF, INF, region.y1, INF), Box(-INF, region.x0, region.y0, region.y1), Box(region.x1, INF, region.y0, region.y1)]
    return leaf_index(spark, [*boxes, *outer])


# How much a prime in the unit counts, and how the area beyond the region does (per percent).
PRIME_WEIGHTS = {2: 0.7, 3: 0.9, 5: 1.0, 7: 0.2, 11: 0.1}
EXTRA_AREA_WEIGHT, FACTOR_OFFSET = 6, 0.9


def _divisions(v: int, primes: tuple[int, ...], least: int) -> dict[int, int]:
    """How often the primes, each in turn, divide v before what is left falls below least."""
    counts = dict.fromkeys(primes, 0)
    for p in primes:
        while v % p == 0:
            v //= p
            if v < least:
                return counts
            counts[p] += 1
    return counts


def root_score(sn: int, we: int, unit: int, sn_least: int, we_least: int, least_side: int) -> float:
    """How good a root of sn x we metres in squares of side unit is: little beyond the region, few squares, a unit that divides often."""
    extra = int(sn * we * 100 / (sn_least * we_least) - 100)
    squares = (sn // unit) * (we // unit)
    primes = _divisions(unit, (2, 3, 5, 7, 11), least_side)
    useful = sum(_divisions(unit, (2, 3, 5, 7), least_side).values())
    return 100 / (100 + EXTRA_AREA_WEIGHT * extra) / math.sqrt(squares) * math.sqrt(sum(PRIME_WEIGHTS[p] * n for p, n in primes.items())) * (math.sqrt(useful) - FACTOR_OFFSET)


def root_sizes(sn: float, we: float, least_side: float) -> tuple[int, int, int]:
    """South-north and west-east metres of the root and the side of its squares.

    Both lengths are whole metres up to a fifth above the region's, the side is their greatest common divisor and at least 16 times
    least_side; that is halved, down to least_side, until there is such a pair. The best score wins, then the smaller lengths. Pairs are listed by
    their divisor: multiples of a side by coprime numbers, so the work follows the pairs that qualify and not all pairs of lengths.
    """
    sn_from, sn_to, we_from, we_to = int(sn), math.ceil(sn * 1.2), int(we), math.ceil(we * 1.2)
    least, target = int(least_side), least_side * 16
    while True:
        best = None
        for unit in range(max(1, int(target + 0.5)), min(sn_to, we_to) + 1):
            for i in range(-(-sn_from // unit), sn_to // unit + 1):
                for j in range(-(-we_from // unit), we_to // unit + 1):
                    if math.gcd(i, j) == 1:
                        found = (-root_score(i * unit, j * unit, unit, sn_from, we_from, least), i * unit, j * unit, unit)
                        best = found if best is None or found < best else best
        if best:
            return best[1:]
        after = target / 2
        if after < least_side < target:
            after = least_side
        if after < least_side:
            raise ValueError(f"no squares of {least_side} m or more fit {sn:.0f} x {we:.0f} m")
        target = after


def square_leaves(spark: SparkSession, sample: DataFrame, x: str, y: str, least: float = 768.0, most: float = 8192.0, share: float = 0.005) -> DataFrame:
    """Squares, quartered where they are larger than most, or large enough to quarter and hold more than a share of the sample (degrees, x is longitude).

    The root lies about the centre of the sample's trimmed bounds and has the sizes of root_sizes(). One count for each leaf and round;
    the leaves are all that the driver holds. Rows beyond the root count in its outer squares.
    """
    base, total = trimmed_region(sample, x, y), sample.count()
    one = leaf_index(spark, [base])
    height, area = geo.meridian_arc(F.col("y0"), F.col("y1")), geo.rect_area(F.col("y0"), F.col("y1"), F.col("x0"), F.col("x1"))
    size = one.select(height.alias("sn"), (area / height).alias("we")).first()
    sn, we, unit = root_sizes(size.sn, size.we, least)
    rows, columns = sn // unit, we // unit
    if 1 in (rows, columns):
        rows, columns = 2 * rows, 2 * columns
    cy, cx = F.lit((base.y0 + base.y1) / 2), F.lit((base.x0 + base.x1) / 2)
    to = lambda metres, toward: geo.destination(cy, cx, F.lit(metres / 2), F.lit(float(toward)))
    edge = spark.range(1).select(to(we, 270)[1].alias("x0"), to(we, 90)[1].alias("x1"), to(sn, 180)[0].alias("y0"), to(sn, 0)[0].alias("y1")).first()
    region = Box(edge.x0, edge.x1, edge.y0, edge.y1)
    xs = [region.x0 + (region.x1 - region.x0) / columns * i for i in range(columns)] + [region.x1]
    ys = [region.y0 + (region.y1 - region.y0) / rows * j for j in range(rows)] + [region.y1]
    boxes = [Box(a, b, p, q) for p, q in zip(ys, ys[1:], strict=False) for a, b in zip(xs, xs[1:], strict=False)]
    clamped = sample.select(geo.clamp(F.col(x), region.x0, math.nextafter(region.x1, -INF)).alias("x"), geo.clamp(F.col(y), region.y0, math.nextafter(region.y1, -INF)).alias("y"))
    while True:
        held = {r.leaf: r["count"] for r in route(clamped, leaf_index(spark, boxes), F.col("x"), F.col("y")).groupBy("leaf").count().collect()}
        areas = {r.leaf: r.area for r in leaf_index(spark, boxes).select("leaf", area.alias("area")).collect()}
        after: list[Box] = []
        for i, b in enumerate(boxes):
            if areas[i] > most * most or areas[i] >= 4 * least * least and held.get(i, 0) > int(total * share):
                mx, my = (b.x0 + b.x1) / 2, (b.y0 + b.y1) / 2
                after += [Box(b.x0, mx, b.y0, my), Box(mx, b.x1, b.y0, my), Box(b.x0, mx, my, b.y1), Box(mx, b.x1, my, b.y1)]
            else:
                after.append(b)
        if len(after) == len(boxes):
            return leaf_index(spark, with_outside(boxes, region))
        boxes = after
