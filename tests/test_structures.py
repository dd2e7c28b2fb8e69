"""Nearest segments, halo blocks, mergeable aggregates and interval labels against plain computations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.operators import geometry as X
from rillflow.operators import mergeable, nearest
from rillflow.operators import network as N
from rillflow.operators import rasters as R


def closest(x, y, segments):
    best = None
    for x1, y1, x2, y2 in segments:
        dx, dy = x2 - x1, y2 - y1
        t = 0.0 if dx == dy == 0 else min(max(((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy), 0), 1)
        px, py = x1 + t * dx, y1 + t * dy
        best = min(best or (math.inf,), (math.hypot(px - x, py - y), px, py))
    return best


def test_nearest_segments(spark):
    """10,000 short and some long segments of one key, points near and far; small keys, one place, and keys without any."""
    rng, segments = random.Random(4), []
    x, y = 0.0, 0.0
    for _ in range(10_000):  # a winding river
        nx, ny = x + rng.gauss(0.02, 0.1), y + rng.gauss(0, 0.1)
        segments.append((1, x, y, nx, ny))
        x, y = nx, ny
    segments += [(1, -50.0, -80.0, 150.0, 90.0), (2, 0.0, 0.0, 1.0, 0.0), (2, 1.0, 0.0, 1.0, 1.0), (3, 5.0, 5.0, 5.0, 5.0)]
    points = [(i, rng.choice([1, 1, 1, 2, 3]), rng.uniform(-60, 260), rng.uniform(-100, 100)) for i in range(60)]
    points += [(100 + i, 1, *rng.choice([(a, b), ((a + c) / 2 + 0.01, (b + d) / 2)])) for i, (_, a, b, c, d) in enumerate(rng.sample(segments[:10_000], 40))] + [(999, 4, 0.0, 0.0)]
    segs = spark.createDataFrame(segments, "comid int, x1 double, y1 double, x2 double, y2 double")
    pts = spark.createDataFrame([(i, x, y, k) for i, k, x, y in points], "id int, x double, y double, comid int")
    got = {r.id: (r.distance, r.x, r.y) for r in nearest.nearest(pts, segs, "comid").collect()}
    own = {k: [s[1:] for s in segments if s[0] == k] for k in (1, 2, 3)}
    assert got == {i: pytest.approx(closest(x, y, own[k]), abs=1e-9) for i, k, x, y in points if k != 4}
    grid = nearest.grids(segs, "comid").cache()
    cells = nearest.cells_of(segs, grid, "comid").cache()
    met = nearest.candidates(pts, cells, grid, "comid").join(cells, ["comid", "depth", "ix", "iy"]).where("comid = 1").groupBy("id").count().collect()
    assert sorted(r["count"] for r in met)[len(met) // 2] < 400  # of 10,001


def test_lines_of_parts(spark):
    geo = "comid int, geometry array<struct<ring int, x double, y double>>"
    lines = spark.createDataFrame([(1, [(0, 0.0, 0.0), (0, 1.0, 0.0), (1, 5.0, 5.0), (1, 6.0, 5.0)])], geo)
    pts = spark.createDataFrame([(1, 0.5, 1.0, 1), (2, 3.0, 3.0, 1), (3, 0.0, 0.0, 2)], "id int, x double, y double, comid int")
    got = {r.id: (r.x, r.y, r.distance) for r in X.snap_to_line(pts, lines, "comid").collect()}
    assert got[1] == (0.5, 0.0, 1.0) and got[2] == (5.0, 5.0, pytest.approx(math.sqrt(8))) and got[3] == (None, None, None)


def test_halo_blocks(spark):
    """The same terrain whatever the blocks; few copies of a pixel; gaps, negative places and two layers."""
    rng = np.random.default_rng(5)
    rows = [(k, int(r), int(c), float(rng.normal())) for k in (1, 2) for r in range(-9, 30) for c in range(-4, 25) if rng.random() < 0.9]
    df = spark.createDataFrame(rows, "layer int, row int, col long, value double").cache()
    whole = {tuple(r)[:3]: tuple(r)[3:] for r in R.terrain(df, ["layer"], 2.0, 3.0).collect()}
    small = {tuple(r)[:3]: tuple(r)[3:] for r in R.terrain(df, ["layer"], 2.0, 3.0, side=4).collect()}
    assert len(whole) == len(rows) and whole.keys() == small.keys()
    for k, v in whole.items():
        assert small[k] == pytest.approx(v, nan_ok=True) if None not in v else small[k] == v
    copies = R.halo_blocks(df.where("layer = 1"), ["layer"], 16).agg(F.sum(F.size("p"))).first()[0]
    assert copies < df.where("layer = 1").count() * (1 + 4 / 16) ** 2
    assert R.terrain(df, ["layer"]).schema["row"].dataType == df.schema["row"].dataType and R.terrain(df.limit(0), ["layer"]).count() == 0


RANGE = mergeable.Mergeable(lambda: None, lambda s, v: (min(v.min(), s[0] if s else v.min()), max(v.max(), s[1] if s else v.max())), lambda a, b: a if b is None else b if a is None else (min(a[0], b[0]), max(a[1], b[1])), lambda s: None if s is None else s[1] - s[0])
COUNT = mergeable.Mergeable(lambda: 0, lambda s, v: s + len(v), lambda a, b: a + b, float)


def test_mergeable(spark):
    """A zone with half of all rows, null keys, null values and an empty table; a task hands over one state per zone."""
    df = spark.range(0, 20_000, 1, 8).selectExpr("CASE WHEN id % 2 = 0 THEN 'big' WHEN id % 7 = 0 THEN NULL ELSE concat('z', id % 50) END AS zone", "CAST(id % 3 AS int) AS band", "CASE WHEN id % 11 > 0 THEN CAST(id AS double) END AS v").union(spark.sql("SELECT 'none', 0, CAST(NULL AS double)"))
    got = {(r.zone, r.band): (r.range, r.n) for r in mergeable.aggregate(df, ["zone", "band"], "v", {"range": RANGE, "n": COUNT}).collect()}
    want = {(r.zone, r.band): (r.range, float(r.n)) for r in df.groupBy("zone", "band").agg((F.max("v") - F.min("v")).alias("range"), F.count("v").alias("n")).collect()}
    assert got == want and got["none", 0] == (None, 0.0)
    plan = mergeable.aggregate(df, ["zone", "band"], "v", {"n": COUNT})._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "_state" in plan[exchange:] and plan.index("MapInArrow") > exchange  # states are made below the shuffle
    assert mergeable.aggregate(df.limit(0), ["zone"], "v", {"n": COUNT}).collect() == []


def ups(links):
    below = {c: d for c, d in links}
    out = set()
    for c in below:
        at, seen = c, set()
        while at in below and at not in seen:
            seen.add(at)
            out.add((at, c))
            at = below[at]
    return out


@pytest.mark.parametrize(("span", "top"), [(4096, 2000), (3, 30)])
def test_interval_labels(spark, monkeypatch, span, top):
    """A path of 2,000 segments with branches and two outlets; a short one beside a cycle with a branch into it."""
    monkeypatch.setattr(N, "SPAN", span)
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(1, top + 1)] + [(5000 + i, rng.randrange(1, top)) for i in range(100)] + [(7000 + i, 5000 + rng.randrange(100)) for i in range(50)] + [(9001, 9002), (9002, 0), (9003, 9002)]
    ring = [(8001, 8002), (8002, 8003), (8003, 8001), (8004, 8003)] if top < 100 else []
    net = spark.createDataFrame([(1, c, d) for c, d in links + ring], "basin int, comid int, next_down int").coalesce(2)
    want = ups(links)
    ids = [1, 20, top, 5003, 9002, 8001, 8004, 77777]
    got = {(r.comid, r.member) for r in N.upstream_sets(net, spark.createDataFrame([(1, i) for i in ids], "basin int, comid int")).collect()}
    cyclic = {(8001, m) for m in (8001, 8002, 8003, 8004)} | {(8004, 8004)} if ring else set()
    assert got == {(a, b) for a, b in want if a in ids} | cyclic
    if ring:
        labels = {r.comid: r for r in N.tour(net).collect()}
        assert {c for c, r in labels.items() if r.root is None} == {c for c, _ in ring}
        assert all(labels[c].exit - labels[c].entry + 1 == sum(a == c for a, _ in want) for c, _ in links)
