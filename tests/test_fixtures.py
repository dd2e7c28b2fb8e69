"""Hand-worked cases of the operators."""

import datetime as dt
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from rillflow.functions import legends as L
from rillflow.functions import scalars as S
from rillflow.operators import climate as C
from rillflow.operators import forcing as O
from rillflow.operators import geometry as X
from rillflow.operators import network as N
from rillflow.operators import rasters as R
from rillflow.operators import signatures as G
from rillflow.operators import tables as B
from rillflow.operators import timeseries as T
from rillflow.operators.shared import in_order
from rillflow.sources import gauges


def at(clock, day=1):
    h, m = map(int, clock.split(":"))
    return dt.datetime(2000, 1, day, h, m)


def hourly(spark, clocks, values, center=True):
    df = spark.createDataFrame([("s", at(c), float(v)) for c, v in zip(clocks.split(","), values, strict=True)], "site string, ts timestamp_ntz, value double")
    return {r.hour.strftime("%H:%M"): r.value for r in T.resample_hourly(df, ["site"], "ts", "value", center).collect()}


def test_hourly_cases(spark):
    assert hourly(spark, "11:30,11:45,12:00,12:15,12:30", [3, 4, 3, 1, 0]) == {"12:00": 8550 / 3600}
    assert hourly(spark, "11:30,11:40,11:57,12:03,12:35", [0, 2, 1, 4, 2])["12:00"] == pytest.approx(8143.125 / 3600)
    got = hourly(spark, "10:30,11:15,12:45,13:30", [1, 1, 10, 10])
    assert got["11:00"] == pytest.approx(1) and got["12:00"] is None and got["13:00"] == pytest.approx(10)
    got = hourly(spark, "10:30,11:15,12:30", [1, 1, 10])
    assert got["11:00"] == pytest.approx(1.225) and got["12:00"] == pytest.approx(6.4)
    steps = [f"{(690 + 15 * i) // 60}:{(690 + 15 * i) % 60:02d}" for i in range(21)]
    values = ([3, 4, 3, 1, 0] * 5)[:21]
    values[-1] = 3
    whole, late = hourly(spark, ",".join(steps), values), hourly(spark, ",".join(steps[1:]), values[1:])
    assert whole["12:00"] != late["12:00"] and all(whole[h] == pytest.approx(late[h]) for h in whole if h != "12:00")


def test_hourly_keeps_volume(spark):
    df = spark.createDataFrame([("s", at(f"{h}:{m}"), float((7 * h + m) % 11)) for h in range(1, 9) for m in (0, 20, 40)], "site string, ts timestamp_ntz, value double")
    total = sum(r.value * 3600 for r in T.resample_hourly(df, ["site"], "ts", "value").collect() if r.value is not None)
    points = [(60 * h + m, (7 * h + m) % 11) for h in range(1, 9) for m in (0, 20, 40)]
    assert total == pytest.approx(sum((a[1] + b[1]) / 2 * (b[0] - a[0]) * 60 for a, b in zip(points, points[1:], strict=False)))


def test_quality(spark):
    rows = [("a", at("1:10"), "A"), ("a", at("1:20"), "P"), ("a", at("1:30"), "A:[91]"), ("b", at("1:10"), "A:e"), ("b", at("1:20"), None), ("c", at("2:00"), "A"), ("d", at("3:15"), "odd")]
    df = spark.createDataFrame(rows, "site string, ts timestamp_ntz, code string")
    got = {(r.site, r.hour.hour): r.quality for r in T.hourly_quality(df, ["site"], "ts", "code").collect()}
    assert got == {("a", 1): "P", ("b", 1): "nan", ("c", 1): "A", ("c", 2): "A", ("d", 3): "odd"}


def test_daylight_time(spark):
    rows = [("x", at("1:30"), "EDT"), ("x", at("5:00"), "EST"), ("y", at("1:30"), "PDT"), ("z", at("1:00"), "EST"), ("z", at("2:00"), "EDT"), ("z", at("3:00"), "CDT")]
    df = spark.createDataFrame(rows, "site string, ts timestamp_ntz, tz string")
    got = [r.ts and r.ts.strftime("%H:%M") for r in T.dst_to_lst(df, ["site"], "ts", "tz").orderBy("site", "ts").collect()]
    assert got == ["00:30", "05:00", None, None, None, None]


def days(spark, start, values, site="s"):
    d0 = dt.date.fromisoformat(start)
    return spark.createDataFrame([(site, d0 + dt.timedelta(i), None if v is None else float(v)) for i, v in enumerate(values)], "site string, day date, q double")


def test_runs_and_periods(spark):
    df = days(spark, "2001-01-01", [1, 1, 0, 1])
    assert [r.length for r in T.run_lengths(df, ["site"], "day", F.col("q") > 0).collect()] == [2]
    assert len(T.run_lengths(df, ["site"], "day", F.col("q") > 0, include_open=True).collect()) == 2
    none = T.period_stats(df, ["site"], "day", {"high": F.col("q") > 5}).first()
    assert (none.frequency, none["mean"], none.median, none.skew, none.kurtosis, none.season) == (0, 0, 0, 0, 0, None)


def test_signatures_of_constant_flow(spark):
    q = days(spark, "1999-10-01", [2.0] * 366)
    assert G.fdc_slope(q, ["site"]).first().slope_mean == 0
    assert G.half_flow(days(spark, "2000-10-01", [2.0] * 365), ["site"]).first().half_day == dt.date(2000, 10, 1) + dt.timedelta(182)
    assert G.baseflow_index(q, ["site"]).first().bfi_mean == pytest.approx(0.8, abs=0.01)
    assert G.fdc_slope(days(spark, "1999-10-01", [0.0] * 366), ["site"]).count() == 0


def test_full_water_years(spark):
    q = days(spark, "1999-06-01", [1.0] * ((dt.date(2002, 12, 31) - dt.date(1999, 6, 1)).days + 1))
    r = T.full_years(q, ["site"], "day", True).agg(F.min("day").alias("a"), F.max("day").alias("z")).first()
    assert (r.a, r.z) == (dt.date(1999, 10, 1), dt.date(2002, 9, 30))
    short = days(spark, "2000-02-01", [1.0] * 50)
    assert T.full_years(short, ["site"], "day").count() == 50


def test_circular(spark):
    df = spark.createDataFrame([(350.0,), (10.0,)], "a double")
    r = df.agg(S.circular_mean(F.col("a")).alias("m"), S.circular_std(F.col("a")).alias("s")).first()
    assert min(r.m, 360 - r.m) == pytest.approx(0, abs=1e-9) and r.s == pytest.approx(math.degrees(math.sqrt(-2 * math.log(math.cos(math.radians(10))))))
    winds = [(10, 10, 225), (10, -10, 315), (-10, 10, 135), (-10, -10, 45), (10, 0, 270), (-10, 0, 90), (0, 10, 180), (0, -10, 0)]
    df = spark.createDataFrame([(float(u), float(v), float(d)) for u, v, d in winds], "u double, v double, d double")
    assert all(r.x == pytest.approx(r.d) for r in df.withColumn("x", S.wind_direction(F.col("u"), F.col("v"))).collect())


@pytest.mark.parametrize(("phase", "want"), [(0.3, 0.5), (0.8, -0.5)])
def test_seasonality(spark, phase, want):
    rows = [("s", dt.date(2001, 1, 1) + dt.timedelta(i), 3 * (1 + 0.5 * math.sin(2 * math.pi * (i / 365 - phase))), 10 + 8 * math.sin(2 * math.pi * (i / 365 - 0.3))) for i in range(365)]
    df = spark.createDataFrame(rows, "site string, day date, p double, t double")
    assert C.seasonality(df, ["site"]).first().seasonality_mean == pytest.approx(want)
    assert C.seasonality(df.where("day <> '2001-03-03'"), ["site"]).first().seasonality_mean is None


def test_units_and_remap(spark):
    df = spark.createDataFrame([(0.0036, 10.0, 1000.0, 10.0)], "`RDRS_v2.1_A_PR0_SFC` double, `RDRS_v2.1_P_TT_1.5m` double, `RDRS_v2.1_P_P0_SFC` double, `RDRS_v2.1_P_UVC_10m` double")
    assert O.convert_units(df, O.RULES["RDRS"]).first() == pytest.approx((0.001, 283.15, 100000.0, 5.14))
    f = spark.createDataFrame([(1, 0, 5.0), (2, 0, 5.0), (3, 0, None)], "cell int, day int, t double")
    w = spark.createDataFrame([(9, 1, 0.2), (9, 2, 0.5), (9, 3, 0.9)], "hru int, cell int, w double")
    assert O.remap(f, w, ["t"], ["day"]).first().t == pytest.approx(5.0)


def test_rasters(spark):
    px = spark.createDataFrame([(0, 0, 1.0, 1), (0, 1, 2.0, 1), (0, 2, 4.0, 1), (1, 0, None, 2)], "row int, col int, value double, zone int")
    z = {r.zone: r for r in R.zonal_stats(px, ["zone"]).collect()}
    assert z[1].harmonic_mean == pytest.approx(12 / 7) and z[2]["mean"] is None and {r.zone: r["mean"] for r in R.zonal_stats(px, ["zone"], empty=0.0).collect()}[2] == 0
    land = spark.createDataFrame([(0, v) for v in (3.0, 1.0, 3.0, 1.0, 2.0)], "pixel int, value double")
    assert R.stack_composite(land, "mode", ["pixel"]).first().value == 1
    soil = R.soil_properties(spark.createDataFrame([(400.0, 200.0)], "sand double, clay double")).first()
    assert soil.porosity == pytest.approx(0.4408) and soil.conductivity == pytest.approx(2.54 * 10 ** (-0.6 + 0.0126 * 40 - 0.0064 * 20))
    plane = spark.createDataFrame([(r, c, float(c)) for r in range(4) for c in range(4)], "row int, col int, value double")
    assert all(r.slope == pytest.approx(45) for r in R.terrain(plane, []).collect())
    fr = R.class_fractions(px, "zone", [1, 2, 7]).where("zone = 1").collect()
    assert {r["class"]: r.fraction for r in fr} == {1: pytest.approx(1 / 3), 2: pytest.approx(1 / 3), 7: 0}


def test_network(spark):
    net = spark.createDataFrame([("b", 1, 3, 5.0, 10.0), ("b", 2, 3, 7.0, 20.0), ("b", 3, 99, 2.0, 5.0)], "basin string, comid long, next_down long, length double, unitarea double")
    assert {r.comid: r.stream_length for r in N.stream_lengths(net).collect()} == {1: 7, 2: 9}
    assert [r.comid for r in N.find_outlets(net).collect()] == [3]
    assert {r.comid: r.area for r in N.upstream_area(net, net.where("comid = 3").select("basin", "comid")).collect()} == {3: 35}
    split = spark.createDataFrame([("b", "1", "3"), ("b", "2", "3"), ("b", "3.1", "99")], "basin string, comid string, next_down string").selectExpr("basin", "CAST(comid AS DECIMAL(12,2)) AS comid", "CAST(next_down AS DECIMAL(12,2)) AS next_down")
    fixed, log = N.repair_links(split)
    assert {float(r.comid): float(r.next_down) for r in fixed.collect()} == {1: 3.1, 2: 3.1, 3.1: 99} and log.count() == 2
    loop = spark.createDataFrame([("b", 1, 2, 1.0), ("b", 2, 3, 1.0), ("b", 3, 2, 1.0)], "basin string, comid long, next_down long, length double")
    assert [(r.comid, r.stream_length) for r in N.stream_lengths(loop).collect()] == [(1, None)]


def ring(*points, number=0):
    return [(number, float(x), float(y)) for x, y in points]


GEO = "poly_id int, geometry array<struct<ring:int,x:double,y:double>>"


def test_geometry(spark):
    tri, holed = ring((0, 0), (4, 0), (0, 4)), ring((0, 0), (10, 0), (10, 10), (0, 10)) + ring((2, 2), (2, 8), (8, 8), (8, 2), number=1)
    polys = spark.createDataFrame([(1, tri), (2, holed)], GEO)
    cells = spark.createDataFrame([(i * 4 + j, i + 0.5, j + 0.5) for i in range(4) for j in range(4)], "cell int, x double, y double")
    w = {r.cell: r.weight for r in X.make_weights(cells, polys.where("poly_id = 1"), 0.5).collect()}
    assert sum(w.values()) == pytest.approx(1) and w[0] == pytest.approx(1 / 8) and w[3] == pytest.approx(0.5 / 8) and 15 not in w
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 5.0, 5.0), (4, 9.0, 5.0), (5, 20.0, 1.0)], "id int, x double, y double")
    got = {(r.id, r.poly_id) for r in X.point_in_polygon(points, polys).collect()}
    assert got == {(1, 1), (1, 2), (4, 2)}
    same = X.overlap_fraction(polys, polys, 0.5).collect()
    assert all(r.fraction == pytest.approx(1) for r in same)
    line = spark.createDataFrame([(7, ring((0, 0), (10, 0)))], "comid int, geometry array<struct<ring:int,x:double,y:double>>")
    pts = spark.createDataFrame([(1, 3.0, 4.0, 7), (2, 1.0, 1.0, 8)], "id int, x double, y double, comid int")
    near = {r.id: (r.x, r.y, r.distance) for r in X.snap_to_line(pts, line, "comid").collect()}
    assert near == {1: (3.0, 0.0, 4.0), 2: (None, None, None)}
    degree = spark.createDataFrame([(1, ring((-96, 39.5), (-95, 39.5), (-95, 40.5), (-96, 40.5)))], GEO)
    area = 6371.007**2 * math.radians(1) * (math.sin(math.radians(40.5)) - math.sin(math.radians(39.5)))
    assert X.poly_area(degree, "poly_id").first().area_km2 == pytest.approx(area, rel=0.01)


def test_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# USGS 02395120\n# 00060 Discharge\nagency_cd\tsite_no\tdatetime\ttz_cd\t9_00060\t9_00060_cd\n5s\t15s\t20d\t6s\t14n\t10s\nUSGS\t02395120\t1989-10-01 01:30\tEDT\t864\tA:[91]\nUSGS\t02395120\t1989-10-01 02:00\tEST\tIce\tP\n")
    lines = gauges.lines(spark, str(tmp_path))
    numbered = spark.createDataFrame([("a", n, x) for n, x in enumerate((tmp_path / "a.txt").read_text().split("\n"))], "file string, n long, line string")
    rows = sorted((r.site, r.datetime, r.tz_cd, r.obs, r.obs_cd) for r in gauges.read_rdb(numbered).collect())
    assert rows == [("02395120", "1989-10-01 01:30", "EDT", "864", "A:[91]"), ("02395120", "1989-10-01 02:00", "EST", "Ice", "P")]
    assert [r.missing for r in gauges.check_header(lines, {"station": "02395120", "stage": "00065"}).collect()] == ["stage"]


def test_months_to_days(spark):
    cols = ["station", "year", "month", "n_days", *[f"flow{i}" for i in range(1, 32)], *[f"symbol{i}" for i in range(1, 32)]]
    row = ("s", 2001, 2, 28, *[float(i) for i in range(1, 32)], *["A"] * 31)
    kinds = ", ".join(f"{c} {'string' if c[:2] in ('st', 'sy') else 'int' if c in ('year', 'month', 'n_days') else 'double'}" for c in cols)
    out = B.hydat_to_daily(spark.createDataFrame([row], kinds))
    assert out.count() == 28 and out.agg(F.max("day"), F.max("flow")).first() == (dt.date(2001, 2, 28), 28.0)


def test_unequal_blocks_fail(spark):
    a, b = spark.createDataFrame([("1",)], "basin string"), spark.createDataFrame([("2",)], "basin string")
    with pytest.raises(ValueError):
        B.merge_blocks([a, b], "basin")


def test_upstream_of_a_long_chain(spark):
    n = 1500
    net = spark.range(1, n + 1).selectExpr("0 AS basin", "id AS comid", "id + 1 AS next_down", "1.0D AS unitarea")
    ids = net.where(f"comid in (1, {n})").select("basin", "comid")
    assert {r.comid: (r.n_up, r.area) for r in N.upstream_area(net, ids).collect()} == {1: (1, 1), n: (n, n)}
    ring = net.withColumn("next_down", F.expr(f"comid % {n} + 1"))
    assert {r.comid: r.n_up for r in N.upstream_area(ring, ids).collect()} == {1: n, n: n}


def test_gaps_in_linear_time(spark):
    """A site of twice the length takes about twice the time, not four times."""
    took = []
    for n in (20_000, 200_000, 400_000):
        df = spark.range(n).selectExpr("1 AS site", "id AS t", "if(id % 7 = 0, id * 2.0, null) AS v").repartition(1)
        began = time.time()
        r = T.interpolate_time(df, ["site"], "t", ["v"]).agg(F.count("v").alias("n"), F.max(F.abs(F.col("v") - 2 * F.col("t"))).alias("d")).first()
        took.append(time.time() - began)
        assert r.n == (n - 1) // 7 * 7 + 1 and r.d < 1e-6
    assert took[2] < 3 * took[1] + 2


def test_upstream_of_branches_and_rings(spark):
    """Sums of every segment of a deep branching network, of a ring, and of what feeds the ring."""
    rng, down = random.Random(3), {}
    for i in range(2, 400):
        down[i] = rng.randrange(1, i) if i % 5 else i - 1
    down |= {1: 0, 500: 501, 501: 502, 502: 500, 503: 500, 504: 503}
    net = spark.createDataFrame([(0, i, d, float(i % 9)) for i, d in down.items()], "basin int, comid long, next_down long, unitarea double")
    up = {i: {i} for i in down}
    for i in down:
        at, seen = i, set()
        while at in down and at not in seen:
            seen.add(at)
            up[at].add(i)
            at = down[at]
    got = {r.comid: (r.n_up, r.area) for r in N.upstream_area(net, net.select("basin", "comid")).collect()}
    assert got == {i: (len(u), float(sum(j % 9 for j in u))) for i, u in up.items()}


def test_order_across_parts(spark):
    """Numbers and running sums over rows that are dealt to many ranges, and merged series in order."""
    rows = [(i * 7919 % 1000, i % 13, f"b{i % 3}") for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, size int, basin string").repartition(5)
    got = [(r.a, r.i, r.total) for r in in_order(df, ["a"], "i", {"total": F.col("size")}).orderBy("a").collect()]
    want, total = [], 0
    for i, (a, size, _) in enumerate(sorted(rows)):
        total += size
        want.append((a, i, total))
    assert got == want
    merged = [(r.basin, r.a) for r in B.merge_periods(df, "basin", "a").collect()]
    assert merged == sorted(merged)
    out = B.size_tradeoff(df.selectExpr("a AS id", "a AS area", "size"), "id", "area", "size").orderBy("id").collect()
    sizes = [s for _, s, _ in sorted(rows)]
    second = [None] + [sizes[i + 1] - sizes[i] for i in range(1, 999)] + [None]
    changes = [i for i in range(2, 999) if second[i] * second[i - 1] < 0]
    assert [r.second for r in out] == second and {r.cut for r in out} == {changes[-1]}


def test_leap_centuries(spark):
    rows = [("s", dt.date(1900, 1, 1) + dt.timedelta(i), 3 * (1 + 0.5 * math.sin(2 * math.pi * (i / 365 - 0.3))), 10 + 8 * math.sin(2 * math.pi * (i / 365 - 0.3))) for i in range(365)]
    df = spark.createDataFrame(rows, "site string, day date, p double, t double")
    assert C.seasonality(df, ["site"]).first().seasonality_mean == pytest.approx(0.5)


def test_overlaps_of_any_shape(spark):
    """Hand-worked areas: disjoint triangles in one box, slanted clips, a hole, a concave basin, and many buckets."""
    lower, upper = ring((0, 0), (1, 0), (0, 1)), ring((1, 1), (0, 1), (1, 0))
    a, b = spark.createDataFrame([(1, lower), (2, lower)], GEO), spark.createDataFrame([(1, upper), (2, ring((0, 0), (1, 0), (1, 1)))], GEO)
    assert {r.poly_id: round(r.fraction, 9) for r in X.overlap_fraction(a, b, 1.0).collect()} == {1: 0, 2: 0.5}
    diamond = ring((5, 0), (10, 5), (5, 10), (0, 5))
    holed = ring((0, 0), (10, 0), (10, 10), (0, 10)) + ring((4, 4), (4, 6), (6, 6), (6, 4), number=1)
    hook = ring((0, 0), (10, 0), (10, 10), (6, 10), (6, 4), (4, 4), (4, 10), (0, 10))
    layer = spark.createDataFrame([(1, diamond), (2, holed), (3, diamond[::-1])], GEO)
    basins = spark.createDataFrame([(7, ring((5, -1), (11, -1), (11, 11), (5, 11))), (8, hook), (9, ring((20, 20), (21, 20), (20, 21)))], GEO.replace("poly_id", "basin_id"))
    for bucket in (1.0, 3.7, 50.0):
        got = {(r.poly_id, r.basin_id): round(r.area, 9) for r in X.overlaps(layer, basins, bucket).collect()}
        slot = 11.0  # of the diamond, between x 4 and 6 above y 4: to y 9 at the sides and to 10 in the middle
        assert got == {(1, 7): 25, (2, 7): 48, (1, 8): 50 - slot, (2, 8): 88, (3, 7): 25, (3, 8): 50 - slot}
    lakes = spark.createDataFrame([(1, 60.0, 12.0), (2, 99.0, 7.0)], "poly_id int, area double, volume double")
    cut = {(r.poly_id, r.basin_id): (r.area, r.volume) for r in X.clip_lakes(lakes, X.overlaps(layer, basins)).collect()}
    assert cut[1, 7] == (25, pytest.approx(5)) and (3, 7) not in cut
    assert {(r.poly_id, r.basin_id) for r in X.intersecting(layer, basins).collect()} == {(p, q) for p in (1, 2, 3) for q in (7, 8)}
    degree = spark.createDataFrame([(1, ring((-96, 39.5), (-95, 39.5), (-95, 40.5), (-96, 40.5)))], GEO)
    whole = X.overlaps(X.projected(degree), X.projected(degree).withColumnRenamed("poly_id", "basin_id"), 37.0).first().area
    assert whole == pytest.approx(X.poly_area(degree, "poly_id").first().area_km2)


def test_zones_of_pixels(spark):
    """Pixels that a slanted polygon touches, and those whose centre it holds."""
    pixels = spark.createDataFrame([(i * 4 + j, i + 0.5, j + 0.5) for i in range(4) for j in range(4)], "pixel int, x double, y double")
    polys = spark.createDataFrame([(1, ring((0, 0), (3, 0), (0, 3))), (2, ring((2, 2), (4, 2), (4, 4), (2, 4))), (3, ring((3.2, 0.2), (3.3, 0.2), (3.3, 0.3)))], GEO)
    touched = {(r.zone, r.pixel) for r in X.assign_zones(pixels, polys, 0.5, 0.5).collect()}
    assert touched == {(1, i * 4 + j) for i in range(3) for j in range(3) if i + j < 3} | {(2, i * 4 + j) for i in (2, 3) for j in (2, 3)} | {(3, 12)}
    centres = {(r.zone, r.pixel) for r in X.assign_zones(pixels, polys, 0.5, 0.5, all_touched=False).collect()}
    assert centres == {(1, i * 4 + j) for i in range(3) for j in range(3) if i + j < 2} | {(2, i * 4 + j) for i in (2, 3) for j in (2, 3)}
    box = X.crop_window(polys.where("poly_id = 1"), "poly_id", 0.3, 0.4).first()
    assert (box.west, box.south, box.east, box.north) == (-0.5, -0.5, 3.5, 3.5)


def test_flags_and_units(spark):
    assert (L.FLAGS["CAN"]["Final/Finales:50"], L.FLAGS["CAN"]["nan:50"], L.FLAGS["CAN"]["Reviewed:20"], L.FLAGS["CAN"]["Preliminary:20"]) == ("Approved, but revised", "Unknown, revised", "Reviewed, but estimated", "Provisional, estimated")
    assert [len(x) for x in L.LEGENDS.values()] == [20, 18, 4] and len(L.FLAGS["CAN"]) == 54
    hourly = spark.createDataFrame([("s", at("1:00"), 1000.0, "A", 1, 0)], "site string, hour timestamp_ntz, value double, quality string, a int, b int")
    flags = {"is_below_sensor_level": F.col("a"), "is_backwater_affected": F.col("b")}
    usa, can = (B.to_flow_product(hourly, ["site"], flags, c) for c in ("USA", "CAN"))
    assert usa.columns[-1] == "q_obs_is_backwater_affected" and usa.first().q_obs == pytest.approx(28.3168466)
    assert can.columns[-1] == "q_obs_is_below_sensor_level" and can.first().q_obs == 1000
    assert [tuple(r) for r in B.flag_meanings(usa, "USA").collect()] == [("A", "Approved, with unknown data grade code")]
    row = spark.range(1).select(S.flow_depth(F.lit(10.0), F.lit(864.0)).alias("mm"), S.flux_depth(F.lit(1e-5), S.seconds_in("month", F.lit(dt.date(2000, 2, 3)))).alias("feb")).first()
    assert row.mm == pytest.approx(1.0) and row.feb == pytest.approx(29 * 0.864)
