"""Cell-bucketed spatial joins equal brute force on small random sets."""

import math
import random

import pytest

from pyspark.sql import functions as F

from georisk.functions import geo
from georisk.operators import spatial
from georisk.params import true_radius_rad


def pts(spark, n, seed, box=(-22.5, -22.0, 166.0, 166.6), name="p"):
    rnd = random.Random(seed)
    rows = [(i, round(rnd.uniform(box[0], box[1]), 4), round(rnd.uniform(box[2], box[3]), 4)) for i in range(n)]
    return spark.createDataFrame(rows, f"{name}_id long, latitude double, longitude double")


def merc(lat, lon):
    R = 6378137.0
    return R * math.radians(lon), R * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))


def seg_dist(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    l2 = dx * dx + dy * dy
    t = 0.0 if l2 == 0 else max(0.0, min(1.0, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / l2))
    return math.hypot(p[0] - (a[0] + t * dx), p[1] - (a[1] + t * dy))


def test_points_near_lines_matches_brute_force(spark):
    p = pts(spark, 400, 1)
    rnd = random.Random(2)
    segs = []
    for e in range(60):
        lat, lon = rnd.uniform(-22.5, -22.0), rnd.uniform(166.0, 166.6)
        segs.append((e, lon, lat, lon + rnd.uniform(-0.05, 0.05), lat + rnd.uniform(-0.05, 0.05)))
    segs.append((99, 166.3, -22.3, 166.3, -22.3))   # zero-length edge
    s = spark.createDataFrame(segs, "edge_id long, lon1 double, lat1 double, lon2 double, lat2 double")
    got = {(r.latitude, r.longitude, r.edge_id) for r in
           spatial.points_near_lines(p, s, 800.0, dedupe=False).collect()}
    want = set()
    for r in p.collect():
        pp = merc(r.latitude, r.longitude)
        for e, lo1, la1, lo2, la2 in segs:
            if seg_dist(pp, merc(la1, lo1), merc(la2, lo2)) <= 800.0:
                want.add((r.latitude, r.longitude, e))
    assert got == want and len(want) > 0


def test_exclude_near_points_matches_brute_force(spark):
    p, e = pts(spark, 300, 3), pts(spark, 200, 4, name="e")
    got = {(r.latitude, r.longitude) for r in spatial.exclude_near_points(p, e, 1500.0).collect()}
    ev = [merc(r.latitude, r.longitude) for r in e.collect()]
    want = set()
    for r in p.collect():
        q = merc(r.latitude, r.longitude)
        if all(math.hypot(q[0] - x, q[1] - y) > 1500.0 for x, y in ev):
            want.add((r.latitude, r.longitude))
    assert got == want and 0 < len(want) < 300


def test_nearest_join_matches_brute_force(spark):
    left, right = pts(spark, 300, 5, name="l"), pts(spark, 40, 6, box=(-22.5, -22.4, 166.0, 166.1), name="r")
    out = spatial.nearest_join(left, right, ["r_id"], tie="r_id")
    got = {r.l_id: r.r_id for r in out.collect()}
    R = right.collect()
    for r in left.collect():
        best = min(R, key=lambda q: (math.hypot(r.latitude - q.latitude, r.longitude - q.longitude), q.r_id))
        assert got[r.l_id] == best.r_id


def test_nearest_haversine_matches_brute_force(spark):
    left, right = pts(spark, 200, 7, name="l"), pts(spark, 30, 8, name="r")
    out = spatial.nearest_join(left, right, ["r_id"], tie="r_id", metric="haversine")
    got = {r.l_id: r.r_id for r in out.collect()}

    def hv(a, b):
        p1, p2 = math.radians(a.latitude), math.radians(b.latitude)
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
            (math.radians(b.longitude) - math.radians(a.longitude)) / 2) ** 2
        return 2 * math.asin(math.sqrt(min(1.0, h)))
    R = right.collect()
    for r in left.collect():
        assert got[r.l_id] == min(R, key=lambda q: (hv(r, q), q.r_id)).r_id


def test_radius_count_matches_brute_force(spark):
    p, e = pts(spark, 150, 9), pts(spark, 400, 10, name="e")
    e2 = e.union(e.limit(50))                               # repeated coordinates count twice
    rad = true_radius_rad(5.0)
    got = {(r.latitude, r.longitude): r.accident_density_5km for r in spatial.radius_count(p, e2, rad).collect()}
    E = e2.collect()
    for r in p.collect():
        n = 0
        for q in E:
            p1, p2 = math.radians(r.latitude), math.radians(q.latitude)
            h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
                (math.radians(q.longitude) - math.radians(r.longitude)) / 2) ** 2
            n += 2 * math.asin(math.sqrt(min(1.0, h))) <= rad
        assert got[(r.latitude, r.longitude)] == n


def test_line_centroid_weighted(spark):
    s = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 0.0), (1, 2.0, 0.0, 2.0, 1.0)],
                              "edge_id long, lon1 double, lat1 double, lon2 double, lat2 double")
    r = spatial.line_centroids(s).first()
    # lengths 2 and 1; midpoints (1,0) and (2,0.5) -> ((2*1+1*2)/3, (0+0.5)/3)
    assert abs(r.centroid_lon - 4 / 3) < 1e-12 and abs(r.centroid_lat - 0.5 / 3) < 1e-12


def test_mercator_constant(spark):
    y = spark.range(1).select(geo.mercator_y(F.lit(-22.0))).first()[0]
    assert abs(y - merc(-22.0, 0)[1]) < 1e-6


def test_cell_join_salting_preserves_result(spark):
    # a hot cell (far above the bound) joins to the same pairs as a plain join
    probe = spark.range(500).select((F.col("id") % 3).alias("_cx"), F.lit(0).alias("_cy"), F.col("id").alias("v"))
    build = spark.createDataFrame([(0, 0, "a"), (0, 0, "b"), (1, 0, "c")], "_cx long, _cy int, w string")
    want = sorted(tuple(r) for r in probe.join(build, ["_cx", "_cy"]).collect())
    got = sorted(tuple(r) for r in spatial.cell_join(probe, build, hot_pairs=100).select(*probe.join(build, ["_cx", "_cy"]).columns).collect())
    assert got == want and len(want) == 167 * 2 + 167


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "p_id long, latitude double, longitude double")
    some = pts(spark, 10, 12)
    assert spatial.nearest_join(empty, some, ["p_id"], tie="p_id").count() == 0
    assert spatial.nearest_join(some, empty, ["p_id"], tie="p_id").filter("nearest_dist IS NULL").count() == 10
    assert spatial.exclude_near_points(some, empty, 100.0).count() == 10
    assert {r.accident_density_5km for r in spatial.radius_count(some, empty, 0.001).collect()} == {0}


# ------------------------------------------------------- stray rows, poles, antimeridian
def _points(spark, rows, cols="latitude double, longitude double"):
    return spark.createDataFrame(rows, cols)


def _brute_nearest(left, right, dist):
    out = {}
    for p in left:
        out[p] = min((dist(p, (r[0], r[1])), r[2]) for r in right)[1]
    return out


@pytest.mark.parametrize("metric", ["euclid_deg", "haversine"])
def test_nearest_with_strays_and_a_far_cluster(spark, metric):
    rng = random.Random(4)
    right = [(-22 + rng.random(), 166 + rng.random(), i) for i in range(400)] + [(50.0, -170.0, 400), (0.0, 0.0, 401)]
    left = {(-22 + rng.random(), 166 + rng.random()) for _ in range(150)}
    left |= {(10 + rng.random() / 50, 20 + rng.random() / 50) for _ in range(60)} | {(0.0, 1.0), (-89.9, 10.0), (5.0, 179.99)}
    left = sorted(left)

    def dist(a, b):
        if metric == "euclid_deg":
            return math.hypot(a[0] - b[0], a[1] - b[1])
        p, q = math.radians(a[0]), math.radians(b[0])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * math.asin(min(1.0, math.sqrt(h)))
    got = spatial.nearest_join(_points(spark, left), _points(spark, right, "latitude double, longitude double, id long"),
                               ["id"], "id", metric=metric)
    assert {(r.latitude, r.longitude): r.id for r in got.collect()} == _brute_nearest(left, right, dist)


def test_stray_rows_leave_the_candidates_few(spark, monkeypatch):
    made = []
    plain = spatial.cell_join

    def counted(*a, **k):
        out = plain(*a, **k)
        made.append(out.count())
        return out
    monkeypatch.setattr(spatial, "cell_join", counted)
    rng = random.Random(2)
    right = [(-22 + rng.random(), 166 + rng.random(), i) for i in range(1500)]
    left = [(-22 + rng.random(), 166 + rng.random()) for _ in range(300)]
    R = _points(spark, right, "latitude double, longitude double, id long")
    totals = []
    for extra in ([], [(0.0, 0.0), (89.0, -120.0)]):
        made.clear()
        spatial.nearest_join(_points(spark, left + extra), R, ["id"], "id").count()
        totals.append(sum(made))
    assert totals[1] < 2 * totals[0] < 2 * 300 * 400          # far fewer than the 450 000 pairs
    totals = []
    for extra in ([], [(90.0, 0.0)]):
        made.clear()
        spatial.radius_count(_points(spark, left), _points(spark, [r[:2] for r in right] + extra), math.radians(0.05)).count()
        totals.append(sum(made))
    assert totals[1] <= totals[0] + 10


def test_radius_count_across_the_antimeridian_and_at_the_pole(spark):
    pts = [(0.0, 179.99), (0.0, -179.99), (89.999, 10.0), (-45.0, 0.0)]
    ev = [(0.0, -179.995), (0.0, 179.985), (89.999, -170.0), (89.998, 100.0), (-45.0, 0.0), (-45.0, 0.0)]
    got = {(r.latitude, r.longitude): r.n for r in spatial.radius_count(
        _points(spark, pts), _points(spark, ev), 5 / 6371.0088, out="n").collect()}
    assert got == {(0.0, 179.99): 2, (0.0, -179.99): 2, (89.999, 10.0): 2, (-45.0, 0.0): 2}


def test_nearest_across_the_antimeridian(spark):
    left = _points(spark, [(0.0, 179.9), (10.0, -179.9)])
    right = _points(spark, [(0.0, -179.9, 1), (0.0, 178.0, 2), (10.0, 179.95, 3), (10.0, -178.0, 4)],
                    "latitude double, longitude double, id long")
    got = spatial.nearest_join(left, right, ["id"], "id", metric="haversine")
    assert {r.latitude: r.id for r in got.collect()} == {0.0: 1, 10.0: 3}


def test_cells_along_a_diagonal_segment(spark):
    seg = _points(spark, [(1, 163.5, -23.0, 168.0, -19.5), (2, 166.0, -22.0, 166.0, -22.1), (3, 165.0, -21.0, 165.0, -21.0)],
                  "edge_id long, lon1 double, lat1 double, lon2 double, lat2 double")
    cells = spatial._cells_along(spatial.segments_mercator(seg), 200.0, 1000.0)
    n = {r.edge_id: r["count"] for r in cells.groupBy("edge_id").count().collect()}
    assert n[1] < 4 * (n_columns := 503) and n[1] > n_columns and n[3] <= 9
    assert cells.select("edge_id", "_cx", "_cy").distinct().count() == cells.count()


def test_empty_right_side_gives_defaults(spark):
    left = _points(spark, [(-22.0, 166.0)])
    right = spark.createDataFrame([], "latitude double, longitude double, id long, road_type int, speed_limit int")
    r = spatial.nearest_join(left, right, ["road_type", "speed_limit"], "id").first()
    assert (r.road_type, r.speed_limit, r.nearest_dist) == (2, 50, None)
