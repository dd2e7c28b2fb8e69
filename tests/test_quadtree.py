"""Quadtree leaves and scan lines against shoelace sums, plain clipping and plain ray tests."""

import math
import random
import time

import numpy as np
import pytest

from rillflow.operators import geometry as X
from rillflow.operators import quadtree as Q
from rillflow.operators import scanline

GEO = "poly_id int, geometry array<struct<ring int, x double, y double>>"


def vertices(ring, number=0):
    return [(number, float(x), float(y)) for x, y in ring]


def circle(n, x=20.3, y=20.7, r=19.5, wobble=0.0):
    return [(x + r * (1 + wobble * math.sin(17 * a)) * math.cos(a), y + r * (1 + wobble * math.sin(17 * a)) * math.sin(a)) for a in (2 * math.pi * i / n for i in range(n))]


def area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]], strict=True))) / 2


def holds(x, y, ring):
    """Plain ray test: west and south sides in, east and north sides out."""
    hit = False
    for (px, py), (qx, qy) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if py > qy:
            px, py, qx, qy = qx, qy, px, py
        if py <= y < qy and x < px + (qx - px) * (y - py) / (qy - py):
            hit = not hit
    return hit


@pytest.mark.parametrize(("n", "seconds"), [(20_000, 6), (80_000, 20)])
def test_large_circle(n, seconds):
    """A ring of many corners over 40 x 40 buckets is cut in one pass; its leaves are small and make up its area."""
    ring, began = np.array(circle(n)), time.time()
    leaves = list(Q.cut([ring], 1.0))
    assert time.time() - began < seconds  # a few seconds on an idle core
    assert sum(x[3] for x in leaves) == pytest.approx(area(ring.tolist()), rel=1e-9)
    assert max(sum(map(len, x[4])) for x in leaves if x[4]) <= Q.VERTICES
    assert sum(len(p) for x in leaves if x[4] for p in x[4]) < 2 * n
    assert len({x[:3] for x in leaves}) == len(leaves) and min(x[0] for x in leaves) < 0


def test_leaves_of_odd_shapes():
    square = np.array([(0.0, 0), (4, 0), (4, 4), (0, 4)])
    assert {x[:3] for x in Q.cut([square], 1.0)} == {(-2, 0, 0)} and next(Q.cut([square], 1.0))[4] is None
    hole = np.array([(1.0, 1), (1, 2), (2, 2), (2, 1)])
    assert sum(x[3] for x in Q.cut([square, hole], 1.0)) == 15
    assert list(Q.cut([], 1.0)) == [] and list(Q.cut([np.array([(0.0, 0), (1, 1), (2, 2)])], 1.0)) == []
    small = np.array([(5e7 + 0.25, 5e7 + 0.25), (5e7 + 0.75, 5e7 + 0.25), (5e7 + 0.75, 5e7 + 0.75)])
    assert sum(x[3] for x in Q.cut([small], 1.0)) == 0.125


def test_points(spark):
    """Points of every kind against the plain test, on sides and corners too, in polygons of mixed sizes."""
    rng = random.Random(7)
    rings = {1: circle(3000, wobble=0.2), 2: [(3, 3), (9, 3), (9, 9), (3, 9)], 3: [(9, 3), (12, 6), (9, 9)], 4: circle(50, 8, 8, 0.7), 5: [(0, 0), (40, 1), (0, 2)]}
    points = [(rng.uniform(-1, 42), rng.uniform(-1, 42)) for _ in range(3000)] + [(x / 2, y / 2) for x in range(5, 26) for y in range(5, 20)]
    df = spark.createDataFrame([(i, float(x), float(y), 1) for i, (x, y) in enumerate(points)], "id int, x double, y double, level int").withColumnRenamed("level", "extra")
    polys = spark.createDataFrame([(k, vertices(r)) for k, r in rings.items()] + [(6, []), (7, None)], GEO)
    want = {(i, k) for i, p in enumerate(points) for k, r in rings.items() if holds(*p, r)}
    for bucket in (1.0, 7.3):
        got = [(r.id, r.poly_id) for r in X.point_in_polygon(df, polys, bucket).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    sides = {i for i, k in want if k == 2}
    assert points.index((3.0, 3.0)) in sides and points.index((9.0, 3.0)) not in sides and points.index((3.0, 9.0)) not in sides


def test_rectangles_and_overlaps(spark):
    """Shared areas of a giant and small polygons with cells of any size add up, and equal direct sums."""
    rings = {1: circle(5000, wobble=0.1), 2: circle(40, 12, 12, 3), 3: [(0, 0), (30, 1), (0.5, 2), (29, 30), (0, 29)]}
    polys = spark.createDataFrame([(k, vertices(r)) for k, r in rings.items()], GEO)
    for step, bucket in ((0.5, 1.0), (5.0, 1.0), (64.0, 2.0)):
        n = math.ceil(50 / step)
        boxes = spark.createDataFrame([(i * n + j, i * step - 5, j * step - 5, (i + 1) * step - 5, (j + 1) * step - 5) for i in range(n) for j in range(n)], "box_id int, rx0 double, ry0 double, rx1 double, ry1 double")
        got = X.clip_layer(polys, boxes, bucket).groupBy("poly_id").sum("area").collect()
        assert {r[0]: r[1] for r in got} == {k: pytest.approx(area(r), rel=1e-9) for k, r in rings.items()}
    other = polys.withColumnRenamed("poly_id", "basin_id")
    for bucket in (1.0, 11.0):
        got = {(r.poly_id, r.basin_id): r.area for r in X.overlaps(polys, other, bucket).collect()}
        for k, r in rings.items():
            assert got[k, k] == pytest.approx(area(r), rel=1e-9)
        assert got[1, 2] == pytest.approx(area(rings[2]), rel=1e-9) and got[1, 3] == pytest.approx(got[3, 1], rel=1e-9)
        assert got[2, 3] == pytest.approx(got[3, 2], rel=1e-9)


def test_shared_areas():
    """Two convex polygons against clipping one by the other's sides."""
    rng = random.Random(9)
    for _ in range(200):
        a, b = (circle(rng.randrange(3, 12), rng.uniform(0, 2), rng.uniform(0, 2), rng.uniform(0.3, 2)) for _ in range(2))
        part = a
        for p, q in zip(b, [*b[1:], b[0]], strict=True):
            side = lambda v, p=p, q=q: (q[0] - p[0]) * (v[1] - p[1]) - (q[1] - p[1]) * (v[0] - p[0])
            new = []
            for u, v in zip(part, [*part[1:], *part[:1]], strict=True):
                if side(u) >= 0:
                    new.append(u)
                if side(u) * side(v) < 0:
                    t = side(u) / (side(u) - side(v))
                    new.append((u[0] + t * (v[0] - u[0]), u[1] + t * (v[1] - u[1])))
            part = new
        want = area(part) if len(part) > 2 else 0.0
        sides = [np.array([(*p, *q) for p, q in zip(r, [*r[1:], r[0]], strict=True)]).T for r in (a, b)]
        got = Q.shared_areas(np.array([0, len(a)]), list(sides[0]), np.array([0, len(b)]), list(sides[1]))
        assert got[0] == pytest.approx(want, abs=1e-12)


def test_scan_lines(spark, monkeypatch):
    """Centres and touched cells against plain tests; polygons side by side hold each centre once."""
    monkeypatch.setattr(scanline, "BAND", 5)
    n = 24
    pixels = [(i * n + j, -3 + 0.5 * i, 2 + 0.25 * j) for i in range(n) for j in range(n)]
    df = spark.createDataFrame([(k, float(x), float(y)) for k, x, y in pixels], "pixel int, x double, y double")
    rng = random.Random(3)
    corners = [[(-3.5 + 3.25 * i + (rng.uniform(-1, 1) if 0 < i < 4 else 0), 1.5 + 1.75 * j + (rng.uniform(-0.6, 0.6) if 0 < j < 4 else 0)) for j in range(5)] for i in range(5)]
    patches = {10 + 4 * i + j: [corners[i][j], corners[i + 1][j], corners[i + 1][j + 1], corners[i][j + 1]] for i in range(4) for j in range(4)}
    shapes = patches | {1: [(-3, 2), (1, 2), (1, 4), (-3, 4)], 2: circle(60, 2, 4, 1.9, 0.3), 3: [(-2.9, 2.1), (-2.8, 2.1), (-2.8, 2.2)], 4: [(-20, -20), (40, 3), (-20, 40)]}
    polys = spark.createDataFrame([(k, vertices(r)) for k, r in shapes.items()] + [(99, None)], GEO)
    got = [(r.pixel, r.zone) for r in X.assign_zones(df, polys, 0.25, 0.125, all_touched=False).collect()]
    assert len(got) == len(set(got)) and set(got) == {(k, z) for k, x, y in pixels for z, r in shapes.items() if holds(x, y, r)}
    inside = [k for k, z in got if z in patches]
    assert len(inside) == len(set(inside)) == n * n  # each centre in exactly one patch
    at = {p[1:]: p[0] for p in pixels}
    one = {k for k, z in got if z == 1}
    assert at[-3, 2] in one and at[1, 3] not in one and at[-3, 4] not in one and at[0.5, 3.75] in one
    touched = [(r.pixel, r.zone) for r in X.assign_zones(df, polys, 0.25, 0.125).collect()]
    boxes = df.selectExpr("pixel AS box_id", "x - 0.25 AS rx0", "y - 0.125 AS ry0", "x + 0.25 AS rx1", "y + 0.125 AS ry1")
    assert len(touched) == len(set(touched)) and set(touched) == {(r.box_id, r.poly_id) for r in X.clip_layer(polys, boxes).collect()}
    assert X.assign_zones(df.limit(0), polys, 0.5, 0.5).count() == 0


def test_copies_are_met_once(spark):
    """Copies of polygons and points: each shape is cut once, no sum holds all pairs, and a polygon of several rows is one."""
    square = lambda x: [(0, x, 0.0), (0, x + 1, 0.0), (0, x + 1, 1.0), (0, x, 1.0)]
    geo = "geometry array<struct<ring int, x double, y double>>"
    a = spark.createDataFrame([(i, square((i % 3) / 4)) for i in range(60)] + [(99, None), (98, [])], f"a int, {geo}")
    b = spark.createDataFrame([(i, square((i % 2) / 2 + 0.5)) for i in range(40)], f"b int, {geo}")
    kinds, members = Q.shapes(a, "a")
    assert kinds.where("size(geometry) > 0").count() == 3 and members.where("a < 60").select("_shape").distinct().count() == 3 and members.where("a < 60").count() == 60
    got = Q.polygon_areas(a, "a", b, "b", 1.0)
    want = {(i, j): s for i in range(60) for j in range(40) if (s := 1 - abs((i % 3) / 4 - (j % 2) / 2 - 0.5)) > 0}
    assert {(r.a, r.b): r.area for r in got.collect()} == pytest.approx(want)
    assert "Aggregate" not in got._jdf.queryExecution().executedPlan().toString()
    points = spark.createDataFrame([(i, (i % 4) / 4 + 0.1, 0.5, "p") for i in range(80)], "id int, x double, y double, more string")
    inside = Q.in_polygons(points, a, "a", 1.0)
    assert inside.columns == ["id", "x", "y", "more", "a"]
    assert sorted((r.id, r.a) for r in inside.collect()) == sorted((p.id, i) for p in points.collect() for i in range(60) if (i % 3) / 4 <= p.x < (i % 3) / 4 + 1)
    parts = spark.createDataFrame([(1, square(0.0)), (1, square(5.0)), (2, square(0.0))], f"a int, {geo}")
    other = spark.createDataFrame([(1, [(0, 0.5, 0.0), (0, 6.0, 0.0), (0, 6.0, 1.0), (0, 0.5, 1.0)])], f"b int, {geo}")
    assert {r.a: r.area for r in Q.polygon_areas(parts, "a", other, "b", 1.0).collect()} == pytest.approx({1: 1.5, 2: 0.5})
    assert [(r.a, r.b, r.area) for r in Q.polygon_areas(parts, "a", other, "b", 1.0, same=True).collect()] == [(1, 1, pytest.approx(1.5))]
    box = spark.createDataFrame([(7, 0.5, 0.0, 6.0, 1.0)], "box int, rx0 double, ry0 double, rx1 double, ry1 double")
    assert {r.a: r.area for r in Q.rectangle_areas(parts, "a", box, "box", 1.0).collect()} == pytest.approx({1: 1.5, 2: 0.5})
