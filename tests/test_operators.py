"""Spatial joins against plain loops, statistics against numpy, merging, partition plans, diffs, refit; plans without nested loops."""

import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetloom.functions import geom
from fleetloom.operators import diff, fit, histogram, merge, order, partition, raster, refit, release, spatial, stats
from fleetloom.plans import join_queries

c = F.col
SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ladder(spark):
    rows = [(i, float(i), float(i), i + 1.0, i + 1.0) for i in range(10)] + [(10, -20.0, 5.5, 20.0, 5.5)]
    return spark.createDataFrame(rows, "seg long, x1 double, y1 double, x2 double, y2 double")




def P():
    return c("x1"), c("y1")


def Q():
    return c("x2"), c("y2")



def test_range_search(spark):
    rects = [((-1, 1, -1, 1), {0}), ((0, 1, 0, 1), {0}), ((0, 2, 0, 2), {0, 1}), ((0, 1, 0, 10), {0, 10}), ((-1, 0, 0, 1), set()), ((10, 11, 0, 10), {10})]
    df = spark.createDataFrame([(i, *map(float, r)) for i, (r, _) in enumerate(rects)], "rect long, a double, b double, p double, q double")
    box = tuple(c(k) for k in "abpq")
    # A box without extent counts openly only where something passes through it; the level segment has none in y.
    level = geom.bounds(P(), Q())
    out = spatial.range_join(df, ladder(spark), box, (level[0], level[1], level[2], F.greatest(level[3], level[2] + 1e-9)), 1.0, geom.clip_interval(P(), Q(), box)[2])
    got = {}
    for r in out.collect():
        got.setdefault(r.rect, []).append(r.seg)
    for i, (_, want) in enumerate(rects):
        assert sorted(got.get(i, [])) == sorted(want)


def test_nearest(spark):
    points = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 2.0), (3, 8.0, 9.0), (4, 50.0, 50.0)], "id long, x double, y double")
    near = spatial.nearest_join(points, ladder(spark), (c("x"), c("y")), (P(), Q()), ["id"], ["seg"], 1.0)
    assert {r.id: (r.seg, round(r.distance, 5)) for r in near.collect()} == {0: (0, 0.0), 1: (1, 0.70711), 3: (8, 0.70711)}
    assert spatial.nearest_join(points.filter("id = 1"), ladder(spark), (c("x"), c("y")), (P(), Q()), ["id"], ["seg"], 0.5).count() == 0


def test_range_join_is_a_filtered_product(spark):
    rng = random.Random(3)
    seg = [(i, *(rng.uniform(0, 10) for _ in range(4))) for i in range(60)]
    pts = [(i, rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(80)]
    s, p = spark.createDataFrame(seg, "seg long, x1 double, y1 double, x2 double, y2 double"), spark.createDataFrame(pts, "id long, x double, y double")
    away = geom.closest(P(), Q(), (c("x"), c("y")))[2]
    got = {(r.id, r.seg) for r in spatial.range_join(p, s, spatial.box_around(c("x"), c("y"), 0.7, 0.7), geom.bounds(P(), Q()), 1.3, away <= 0.7).collect()}
    want = {(r.id, r.seg) for r in p.crossJoin(s).filter(away <= 0.7).collect()}
    assert got == want and want


@pytest.mark.parametrize("query", ["j01", "j03", "j05", "j06", "j08", "j09"])
def test_spatial_plans_have_no_nested_loops(spark, query):
    text = plan(getattr(join_queries, query)(spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_weighted_median_is_the_first_to_reach_half(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), float(v), float(w)) for g, v, w in zip(rng.integers(0, 5, 500), rng.integers(0, 60, 500), rng.integers(1, 9, 500), strict=True)]
    got = {r.g: r.v_median for r in stats.weighted_median(spark.createDataFrame(rows, "g int, v double, w double"), ["g"], ["v"], "w").collect()}
    for g in range(5):
        own = sorted((v, w) for k, v, w in rows if k == g)
        half, total = sum(w for _, w in own) / 2, 0
        for v, w in own:
            total += w
            if total >= half:
                break
        assert got[g] == v


@pytest.mark.parametrize("shift", [(0, 0), (20000, -15000)])
def test_orthogonal_fit_of_turned_lines(spark, shift):
    rng = np.random.default_rng(7)
    rows = []
    for angle in range(0, 360, 15):
        a, u, e = math.radians(angle), rng.uniform(-50, 50, 1000), rng.normal(scale=2, size=1000)
        rows += [(angle, float(x), float(y)) for x, y in zip(shift[0] + u * math.cos(a) - e * math.sin(a), shift[1] + u * math.sin(a) + e * math.cos(a), strict=True)]
    df = spark.createDataFrame(rows, "angle int, x double, y double")
    m = stats.moments(df, ["angle"], c("x"), c("y"), F.lit(1.0), tuple(F.lit(float(s)) for s in shift))
    for r in fit.orthogonal(m, ["angle"]).collect():
        off = math.degrees(math.atan2(r.y2 - r.y1, r.x2 - r.x1)) - r.angle
        assert abs((off + 90) % 180 - 90) < 0.6


def test_fits_without_spread(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 1.0, 1.0), (1, 0.0, 2.0), (1, 4.0, 2.0), (2, 3.0, 0.0), (2, 3.0, 5.0), (3, 1.0, 1.0)], "g int, x double, y double")
    got = {r.g: (r.x1, r.y1, r.x2, r.y2) for r in fit.orthogonal(stats.moments(df, ["g"], c("x"), c("y"), F.lit(1.0)), ["g"]).collect()}
    assert set(got) == {1, 2} and got[1] == pytest.approx((0, 2, 4, 2)) and got[2] == pytest.approx((3, 0, 3, 5))
    ols = {r.g: (r.slope, r.intercept, r.y_dominant) for r in fit.least_squares(df, ["g"], c("x"), c("y")).collect()}
    assert ols[1] == (0.0, 2.0, False) and ols[2] == (0.0, 3.0, True) and ols[0][0] is None


def test_histogram_palette(spark):
    cells = spark.createDataFrame([(0, 0, 3), (0, 1, 3), (1, 1, 9)], "hist_row int, hist_col int, hits long")
    got = histogram.palette(histogram.cumulative(histogram.intensities(cells, 6))).orderBy("intensity").collect()
    assert [tuple(r) for r in got] == [(0, 3, 3, 0), (3, 2, 5, 170), (9, 1, 6, 255)]


def report(ms, route="1", direction="a", heading=10, lat=1.0, lon=2.0, vehicle="v"):
    return (vehicle, ms, route, direction, heading, lat, lon)


def merged(spark, rows, **kw):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "vehicle_id string, unix_ms long, route_tag string, dir_tag string, heading int, lat double, lon double, arrival long")
    out = merge.merge_reports(df, "arrival", **kw).orderBy("vehicle_id", "unix_ms")
    return [(r.vehicle_id, r.unix_ms, r.route_tag, r.dir_tag, r.dropped) for r in out.collect()]


def test_merge_rules(spark):
    assert merged(spark, [report(1000), report(2000), report(3000)]) == [("v", 2000, "1", "a", 0)]
    assert merged(spark, [report(1000), report(3001)]) == [("v", 1000, "1", "a", 0), ("v", 3001, "1", "a", 0)]
    assert merged(spark, [report(1000), report(1500, direction="b")]) == [("v", 1250, "1", "a", 0), ("v", 1251, "1", "b", 0)]
    assert merged(spark, [report(1000), report(1500, direction="b"), report(1501)]) == [("v", 1334, "1", "a", 0)]
    assert merged(spark, [report(5000), report(1000, heading=9), report(9000)]) == [("v", 5000, "1", "a", 1), ("v", 9000, "1", "a", 1)]
    assert merged(spark, [report(5000), report(4000)]) == [("v", 4500, "1", "a", 0)]  # within 2 s, though earlier
    assert merged(spark, []) == []


def test_latest_and_order(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 6), (4, 7), (5, 3)], "i long, t long").withColumn("k", F.lit(0))
    assert [r.i for r in stats.order_violations(df, "t", ["k"], ["i"]).orderBy("i").collect()] == [3, 5]
    assert merge.latest(df, "k", ["t", "i"]).first().i == 4


def places(n=12_000, seed=2):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(-71.05, 0.04, n // 2), rng.uniform(-71.3, -70.9, n - n // 2 - 4), [-80.0, -60.0, -71.0, -71.0]])
    y = np.concatenate([rng.normal(42.3, 0.03, n // 2), rng.uniform(42.1, 42.6, n - n // 2 - 4), [42.3, 42.3, 10.0, 60.0]])
    return [(float(a), float(b)) for a, b in zip(x, y, strict=True)]


def metres(lat1, lon1, lat2, lon2):
    u, v = math.sin(math.radians(lat2 - lat1) / 2), math.sin(math.radians(lon2 - lon1) / 2)
    a = u * u + v * v * math.cos(math.radians(lat1)) * math.cos(math.radians(lat2))
    return (6378137.0 - 21384.7 * abs(math.sin(math.radians((lat1 + lat2) / 2)))) * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def near_ends(values, k=20):
    v = sorted(values)
    return sum(v[k // 2 : k]) / (k // 2), sum(v[len(v) - k : len(v) - k // 2]) / (k // 2)


def plain_equal_counts(rows, cuts, levels):
    """Finite leaves and what they hold, on lists."""
    (x0, x1), (y0, y1) = near_ends([x for x, _ in rows]), near_ends([y for _, y in rows])
    mx, my = sorted(x for x, _ in rows)[len(rows) // 2], sorted(y for _, y in rows)[len(rows) // 2]
    if metres(my, x0, my, x1) >= metres(y0, mx, y1, mx):
        rows = [r for r in rows if x0 <= r[0] <= x1]
        y0, y1 = near_ends([y for _, y in rows])
    else:
        rows = [r for r in rows if y0 <= r[1] <= y1]
        x0, x1 = near_ends([x for x, _ in rows])
    rows = [r for r in rows if x0 <= r[0] <= x1 and y0 <= r[1] <= y1]

    def cut(box, own, level):
        a, b, p, q = box
        wide, high = metres((p + q) / 2, a, (p + q) / 2, b), metres(p, 0, q, 0)
        if level == levels or max(wide, high) <= 500:
            return [(box, len(own))]
        axis = 0 if wide >= high else 1
        own, out, lo = sorted(own, key=lambda r: r[axis]), [], (a, p)[axis]
        for left in range(cuts + 1, 0, -1):
            n = len(own) // left
            hi = own[n][axis] if left > 1 else (b, q)[axis]
            out += cut((lo, hi, p, q) if axis == 0 else (a, b, lo, hi), own[:n], level + 1)
            own, lo = own[n:], hi
        return out

    return cut((x0, x1, y0, y1), rows, 2)


def test_equal_count_plan_against_lists(spark):
    rows = places()
    df = spark.createDataFrame(rows, "x double, y double").cache()
    leaves = partition.equal_count_leaves(spark, df, "x", "y", 2, 5)
    want = plain_equal_counts(rows, 2, 5)
    boxes = leaves.orderBy("leaf").collect()
    finite = [b for b in boxes if all(map(math.isfinite, b[1:]))]
    assert len(want) == 27 and sorted(tuple(round(v, 9) for v in b[1:]) for b in finite) == sorted(tuple(round(v, 9) for v in box) for box, _ in want)
    counts = {r.leaf: r["count"] for r in partition.route(df, leaves, c("x"), c("y")).groupBy("leaf").count().collect()}
    assert None not in counts and sum(counts.values()) == len(rows)
    inner = [counts[b.leaf] for b in finite]
    assert max(inner) - min(inner) <= 4
    with pytest.raises(ValueError, match="too few"):
        partition.equal_count_leaves(spark, df.limit(500), "x", "y", 2, 5)


def plain_root(sn, we, least):
    a, b, target = int(sn), int(we), least * 16
    while True:
        pairs = [(i, j, math.gcd(i, j)) for i in range(a, math.ceil(sn * 1.2) + 1) for j in range(b, math.ceil(we * 1.2) + 1)]
        pairs = [p for p in pairs if p[2] >= int(target + 0.5)]
        if pairs:
            return min(pairs, key=lambda p: (-partition.root_score(*p, a, b, int(least)), p[0], p[1]))
        target = max(target / 2, least)


def test_root_sizes_against_all_pairs():
    for sn, we, least in ((330.0, 550.0, 4.0), (200.0, 200.0, 3.0), (410.5, 90.25, 5.0), (97.0, 101.0, 7.0)):
        assert partition.root_sizes(sn, we, least) == plain_root(sn, we, least)
    # 360 = 2*2*2*3*3*5: its primes down to a rest of 3, and 18 % of area beyond.
    want = 100 / (100 + 6 * 18) / math.sqrt(1 * 1) * math.sqrt(3 * 0.7 + 2 * 0.9) * (math.sqrt(5) - 0.9)
    assert partition.root_score(360, 360, 360, 331, 331, 3) == pytest.approx(want)
    with pytest.raises(ValueError, match="no squares"):
        partition.root_sizes(40.0, 3.0, 10.0)


def test_square_plan_covers_every_point_once(spark, tmp_path):
    rows = places()
    df = spark.createDataFrame(rows, "x double, y double").cache()
    leaves = partition.square_leaves(spark, df, "x", "y", 500.0, 6000.0, 0.005)
    partition.write_plan(leaves, str(tmp_path / "plan"))
    back = partition.read_plan(spark, str(tmp_path / "plan"))
    boxes = leaves.orderBy("leaf").collect()
    assert boxes == back.orderBy("leaf").collect() and len(boxes) > partition.FEW
    routed = partition.route(df, back, c("x"), c("y"))
    assert "NestedLoop" not in plan(routed) and routed.columns == ["x", "y", "leaf"]
    counts = {}
    for r in routed.collect():
        b = boxes[r.leaf]
        assert b.x0 <= r.x < b.x1 and b.y0 <= r.y < b.y1
        counts[r.leaf] = counts.get(r.leaf, 0) + 1
    for b in boxes:
        if all(map(math.isfinite, b[1:])):
            mid = (b.y0 + b.y1) / 2
            wide, high = metres(mid, b.x0, mid, b.x1), metres(b.y0, 0, b.y1, 0)
            assert abs(wide / high - 1) < 0.02 and wide * high <= 1.02 * 6000**2
            assert counts.get(b.leaf, 0) <= 0.005 * len(rows) or wide * high < 1.02 * 4 * 500**2
    wanted = set(partition.overlapping(leaves, (-71.1, -71.0, 42.25, 42.35)))
    assert {r.leaf for r in routed.filter("x BETWEEN -71.1 AND -71.0 AND y BETWEEN 42.25 AND 42.35").collect()} <= wanted and len(wanted) < len(boxes)


def test_pruned_scan_reads_few_leaves(spark, tmp_path):
    leaves = partition.grid_leaves(spark, [1.0, 2.0], [1.0])
    df = spark.createDataFrame([(i / 10, (i % 20) / 10) for i in range(30)], "x double, y double")
    partition.write_leaves(partition.route(df, leaves, c("x"), c("y")), str(tmp_path / "leaves"))
    back = spark.read.parquet(str(tmp_path / "leaves")).filter(c("leaf").isin(partition.overlapping(leaves, (0.1, 0.5, 0.1, 0.5))))
    assert "PartitionFilters: [isnotnull" in plan(back) or "PartitionFilters: [(leaf" in plan(back) or "PartitionFilters: [leaf" in plan(back)
    assert 0 < back.count() < 30


def test_deep_diff(spark):
    schema = "id long, a struct<b:int,c:string>, l array<int>, m map<string,int>"
    one = spark.createDataFrame([(1, (1, "x"), [1, 2], {"k": 1}), (2, None, [], {}), (3, (1, "x"), [1], {})], schema)
    two = spark.createDataFrame([(1, (2, "x"), [1, 2, 3], {"k": 2, "n": 1}), (2, (None, None), None, {}), (3, (1, "x"), [1], {})], schema)
    got = {(r.id, r.path, r.kind, r.v1, r.v2) for r in diff.deep_diff(one, two, "id").collect()}
    assert {(1, "a.b", "value", "1", "2"), (1, "l.length", "length", "2", "3"), (1, "l[2]", "extra", None, "3"), (1, "m[k]", "value", "1", "2"), (1, "m[n]", "extra", None, "1")} <= got
    assert any(i == 2 and p.startswith("l") for i, p, *_ in got) and not any(i == 3 for i, *_ in got)


def test_deep_diff_reaches_into_lists_and_maps(spark):
    schema = "id long, s array<struct<t:string,n:array<int>>>, m map<string,struct<a:int>>"
    one = spark.createDataFrame([(1, [("x", [1]), ("y", None)], {"k": (1,)})], schema)
    two = spark.createDataFrame([(1, [("x", [1, 2]), ("z", [])], {"k": (2,)})], schema)
    got = {(r.path, r.kind, r.v1, r.v2) for r in diff.deep_diff(one, two, "id").collect()}
    assert got == {("s[0].n.length", "length", "1", "2"), ("s[0].n[1]", "extra", None, "2"), ("s[1].t", "value", "y", "z"), ("s[1].n", "missing", None, None), ("s[1].n.length", "extra", None, "0"), ("m[k].a", "value", "1", "2")}
    assert {r.path for r in diff.deep_diff(one, two, "id", ignore=[r"s\[\d+\]\.n.*", r"m\[k\].*"]).collect()} == {"s[1].t"}


def test_culling(spark):
    e, f1, f2, d = diff.EQUIVALENT, diff.FIRST_MORE, diff.SECOND_MORE, diff.DIFFERENT

    def gone(*verdicts):
        steps = F.array(*(F.struct(F.lit(i).cast("long").alias("id"), F.lit(v).alias("verdict")) for i, v in enumerate(verdicts, 1)))
        return sorted(x for x in spark.range(1).select(diff.cull_fold(steps).alias("g")).first().g if x is not None)

    assert gone(d, e, e, e, d) == [2, 3] and gone(d, f1, e) == [2] and gone(d, e, f2) == [1, 2] and gone(d) == [] and gone(d, d) == []
    rows = spark.createDataFrame([("s", i, k) for i, k in enumerate("aaabba")], "s string, i int, k string")
    assert [r.kept for r in diff.cull_runs(rows, ["s"], "i", "k").orderBy("i").collect()] == [True, False, True, True, True, True]


def test_refit_finds_the_road_again(spark):
    rng = np.random.default_rng(9)
    road = [(0, 0), (300, 40), (600, 200)]
    rows = []
    for (x1, y1), (x2, y2) in zip(road, road[1:], strict=False):
        a, n = math.atan2(y2 - y1, x2 - x1), 400
        t, e = rng.uniform(0, 1, n), rng.normal(scale=3, size=n)
        rows += [(float(x1 + s * (x2 - x1) - k * math.sin(a)), float(y1 + s * (y2 - y1) + k * math.cos(a)), a % (2 * math.pi), "in") for s, k in zip(t, e, strict=True)]
        rows += [(float(x1 + s * (x2 - x1)), float(y1 + s * (y2 - y1) + 25), (a + math.pi) % (2 * math.pi), "out") for s in rng.uniform(0, 1, 60)]
    reports = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "report_id long, x double, y double, direction double, dir_tag string")
    start = spark.createDataFrame([(1, k, float(x + dx), float(y + dy)) for k, ((x, y), (dx, dy)) in enumerate(zip(road, [(5, 12), (-8, 10), (4, -14)], strict=True))], "path_index long, position long, x double, y double")
    new = refit.refit(reports, start, 40.0, rounds=3).orderBy("position").collect()
    assert len(new) == 3
    for r, (x, y) in zip(new[1:2], road[1:2], strict=True):
        assert math.hypot(r.x - x, r.y - y) < 12
    line = lambda p, q, r: abs((q[0] - p[0]) * (p[1] - r.y) - (p[0] - r.x) * (q[1] - p[1])) / math.dist(p, q)
    assert line(road[0], road[1], new[0]) < 3 and line(road[1], road[2], new[2]) < 3


def test_pictures(spark):
    df = spark.createDataFrame([(0, 0, 4, 2), (3, 1, 3, 1), (2, 5, 0, 0)], "c1 int, r1 int, c2 int, r2 int")
    cells = raster.line_cells(df, c("c1"), c("r1"), c("c2"), c("r2")).collect()
    assert len(cells) == 5 + 1 + 6
    for a, b in [((0, 0), (2, 4)), ((1, 3), (1, 3)), ((5, 2), (0, 0))]:
        assert {a, b} <= {(r.pic_row, r.pic_col) for r in cells}
    box = raster.rectangle_cells(df.limit(1), F.lit(1), F.lit(1), F.lit(4), F.lit(3)).select("pic_row", "pic_col").distinct().count()
    assert box == 10
    image = raster.png(spark.createDataFrame([(0, 0, 255), (1, 2, 7)], "hist_row int, hist_col int, level int"), 3, 2)
    assert image[:8] == b"\x89PNG\r\n\x1a\n" and image[16:24] == (3).to_bytes(4, "big") + (2).to_bytes(4, "big")


def test_merge_of_a_busy_vehicle_and_of_missing_tags(spark):
    rows = [report(1000, route=None, heading=None), report(1500, route=None, heading=None), report(1800, heading=None)]
    assert merged(spark, rows) == [("v", 1433, None, "a", 0), ("v", 1434, "1", "a", 0)]
    assert merged(spark, [report(1000), report(1500, direction="b")], same_tags=True) == [("v", 1000, "1", "a", 0), ("v", 1500, "1", "b", 0)]
    n = 60_000
    many = spark.range(n).select(F.lit("v").alias("vehicle_id"), (c("id") * 700 + c("id") % 7 * 400).alias("unix_ms"), F.lit("1").alias("route_tag"), (c("id") % 3).cast("string").alias("dir_tag"), F.lit(1).alias("heading"), F.expr("CAST(id DIV 5 AS DOUBLE)").alias("lat"), F.lit(2.0).alias("lon"), c("id").alias("arrival"))
    began = time.monotonic()
    got = sorted((r.unix_ms, r.dir_tag, r.dropped) for r in merge.merge_reports(many, "arrival").collect())
    assert time.monotonic() - began < 30
    state, want, dropped = None, [], 0
    for i in range(n):
        before = state
        state, done = merge.step(state, (i * 700 + i % 7 * 400, "1", str(i % 3), 1, float(i // 5), 2.0))
        if done:
            want += merge.merged_rows("v", done)
        elif state is before:
            dropped += 1
    want += merge.merged_rows("v", state)
    assert got == sorted((w[1], w[3], dropped) for w in want)


RESPONSES = [
    # (response, vehicle, ms, heading): b falls silent, c comes late, a repeats itself
    (1, "a", 10_000, 1), (1, "b", 9_000, 1), (2, "a", 10_500, 1), (2, "c", 12_000, 1), (3, "a", 20_000, 2), (3, "c", 21_000, 2), (4, "a", 30_000, 3), (4, "c", 29_000, 3),
    (5, "a", 40_000, 4), (5, "c", 41_000, 4), (6, "a", 50_000, 5), (6, "c", 50_000, 5), (7, "c", 60_000, 6),
]


def test_release_in_order_of_time(spark):
    rows = [("f", r, v, ms, "1", "d", h, 1.0, 2.0) for r, v, ms, h in RESPONSES] + [("g", 1, "x", 5, None, None, None, 1.0, 2.0), ("g", 2, None, 6, "1", "d", 1, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "feed string, response int, vehicle_id string, unix_ms long, route_tag string, dir_tag string, heading int, lat double, lon double")
    got = release.release_reports(df, "response").orderBy("feed", "place").collect()
    # b counts as recent up to the fourth response, so the watermark stays at 6,000; with the fifth it is that of a and c: 37,000, and b, 28 s behind it, goes.
    want = [("b", 9_000, 37_000), ("a", 10_250, 37_000), ("c", 12_000, 37_000), ("a", 20_000, 37_000), ("c", 21_000, 37_000), ("c", 29_000, 37_000), ("a", 30_000, 37_000)]
    want += [("a", 40_000, 47_000), ("c", 41_000, 47_000), ("a", 50_000, 47_000), ("c", 50_000, 47_000), ("c", 60_000, 47_000)]
    assert [(r.vehicle_id, r.unix_ms, r.watermark_ms) for r in got if r.feed == "f"] == want
    assert [r.place for r in got if r.feed == "f"] == list(range(1, len(want) + 1))
    assert [(r.vehicle_id, r.unix_ms, r.heading) for r in got if r.feed == "g"] == [("x", 5, None)]
    feed = release.Feed()
    out = []
    for _, own in itertools.groupby(RESPONSES, key=lambda r: r[0]):
        out += feed.respond((v, ms, "1", "d", h, 1.0, 2.0) for _, v, ms, h in own)
        feed = release.Feed.load(feed.dump())  # as a stream's state is kept
    assert [(v, ms, w) for _, w, v, ms, *_ in [*out, *feed.close()]] == want


def test_bounded_sort(spark):
    rng = random.Random(5)
    rows = [(k, i, rng.randrange(10_000) if rng.random() < 0.05 else i + rng.randrange(-20, 20)) for k in (1, 2, None) for i in range(700)]

    def plain(times, buffer, emit):
        out, waiting = [], []
        for i, t in enumerate(times):
            waiting.append((t, i))
            if len(waiting) == buffer:
                waiting.sort()
                out, waiting = out + waiting[:emit], waiting[emit:]
        return [i for _, i in out + sorted(waiting)]

    df = spark.createDataFrame(rows, "k int, i int, t int").withColumn("name", F.lit("x"))
    for buffer, emit in ((100, 40), (10, 5), (1000, 500)):
        got = order.bounded_sort(df, ["k"], ["i"], ["t"], buffer, emit).collect()
        for k in (1, 2, None):
            own = sorted((r for r in got if r.k == k), key=lambda r: r.place)
            assert [r.place for r in own] == list(range(1, 701))
            assert [r.i for r in own] == plain([t for q, _, t in rows if q == k], buffer, emit)
    assert order.bounded_sort(df.limit(0), ["k"], ["i"], ["t"]).count() == 0


def test_trimmed_extrema_need_enough_samples(spark):
    assert [stats.samples_near_extrema(n) for n in (10_000, 99_999, 100_000, 1_000_000)] == [20, 20, 50, 200]
    with pytest.raises(ValueError, match="too few"):
        stats.samples_near_extrema(9_999)


def test_verdicts_on_consecutive_directories(spark):
    rows = [("a", "x", "1"), ("a", "y", "1"), ("b", "x", "1"), ("c", "x", "1"), ("c", "z", None), ("d", "x", "1"), ("d", "z", None), ("e", "x", "2"), ("e", "z", None), ("f", "q", "1")]
    got = diff.directory_verdicts(spark.createDataFrame(rows, "d string, n string, c string"), "d", "n", "c").orderBy("first").collect()
    want = [("a", "b", diff.FIRST_MORE), ("b", "c", diff.SECOND_MORE), ("c", "d", diff.EQUIVALENT), ("d", "e", diff.DIFFERENT), ("e", "f", diff.DIFFERENT)]
    assert [tuple(r) for r in got] == want
    assert "NestedLoop" not in plan(diff.directory_verdicts(spark.createDataFrame(rows, "d string, n string, c string"), "d", "n", "c"))
