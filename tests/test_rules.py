"""Hand-worked edges of single rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillflow.operators import climate as C
from rillflow.operators import forcing as O
from rillflow.operators import tables as B
from rillflow.operators import timeseries as T


def test_nearest_reference(spark):
    """Either side of a rounding edge, two references in a cell, a tie, none near, and repeated rows."""
    ref = spark.createDataFrame([(10.0000504, 1.0), (10.2000001, 1.0), (10.2000002, 1.0), (20.0, 2.0), (20.00008, 2.0)], "x double, y double")
    df = spark.createDataFrame([(1, 10.0000496, 1.0), (2, 10.20000016, 1.0), (3, 20.00004, 2.0), (4, 30.0, 2.0), (5, 10.0000496, 1.0), (6, 10.0000496, 1.00011), (7, None, 1.0)], "id int, x double, y double")
    got = {r.id: (r.x, r.y) for r in O.align_coords(df, ref, ["x", "y"]).collect()}
    assert got == {1: (10.0000504, 1.0), 2: (10.2000002, 1.0), 3: (20.0, 2.0), 5: (10.0000504, 1.0)}
    assert O.align_coords(df, ref, ["x", "y"]).columns == ["id", "x", "y"]


def test_last_layers(spark):
    days = [dt.date(2018 + i // 12, i % 12 + 1, 1) for i in range(25)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    kept = lambda **k: [r.day for r in B.filter_dates(df, "day", **k).orderBy("day").collect()]
    assert kept(last_months=24)[0] == dt.date(2018, 1, 1) == kept(last_years=2)[0] and kept(last_years=1)[0] == dt.date(2019, 1, 1)
    assert kept(last_days=31) == [dt.date(2019, 12, 1), dt.date(2020, 1, 1)] and len(kept()) == 25
    assert kept(year=[2019], month=[2, 3], dom=[1]) == [dt.date(2019, 2, 1), dt.date(2019, 3, 1)]
    with pytest.raises(ValueError, match="only one"):
        kept(last_years=1, last_days=3)


def test_wind_components(spark):
    df = spark.createDataFrame([(1.0, 10.0, 2.0, 0.0036)], "u double, v double, w double, p double").toDF("RDRS_v2.1_P_UUC_10m", "RDRS_v2.1_P_VVC_10m", "RDRS_v2.1_P_UVC_10m", "RDRS_v2.1_A_PR0_SFC")
    assert tuple(O.convert_units(df, O.RULES["RDRS"]).first()) == pytest.approx((0.514, 5.14, 1.028, 0.001))


def test_reasons(spark):
    rows = [("a", dt.datetime(2000, m, 15, 5 + h), 1.0) for m in (1, 2, 4) for h in range(3)] + [("b", dt.datetime(2000, 1, 31, 22), 1.0), ("b", dt.datetime(2000, 1, 31, 23), 1.0), ("b", dt.datetime(2000, 2, 1, 0), 1.0)]
    df = spark.createDataFrame(rows, "site string, ts timestamp, p double")
    got = {tuple(r) for r in O.check_forcing(df, ["site"], "ts", ["p", "phi"], months=True).collect()}
    assert got == {("a", "absent phi"), ("a", "missing months"), ("a", "time steps"), ("b", "absent phi")}


def test_canadian_codes(spark):
    assert len(T.WSC_ORDER) == len(set(T.WSC_ORDER)) == 48
    at = lambda m: dt.datetime(2000, 1, 1, 3, m)
    rows = [("a", at(10), "Final/Finales", -1), ("a", at(20), "Provisional/Provisoire", 10), ("b", at(10), "Approved", None), ("b", at(20), None, 50), ("c", at(10), "Final/Finales", 40), ("c", at(20), "Final/Finales", 0)]
    df = spark.createDataFrame(rows, "site string, ts timestamp_ntz, approval string, grade int")
    got = {r.site: (r.quality, r.is_ice) for r in T.hourly_quality_can(df, ["site"], "ts", "approval", "grade").collect()}
    assert got == {"a": ("Provisional/Provisoire:10", 1), "b": ("nan:50", 0), "c": ("Final/Finales:0", 0)}
    flags = T.status_flags(spark.createDataFrame([("A",), ("B",), ("D",), ("E",), (None,)], "s string"), "s", T.CAN_SYMBOLS)
    assert [tuple(r)[1:] for r in flags.collect()] == [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (0, 0, 0, 0)]


def test_hot_days(spark):
    """One hot hour makes a hot day of 24 steps; lengths are in days."""
    rows = []
    for year, hot in ((2000, {10, 11}), (2001, set())):
        rows += [("s", dt.datetime(year, 1, 1) + dt.timedelta(days=i, hours=h), 290.0 + (20 if i in hot and h == 15 else 0), 0.1) for i in range(20) for h in range(24)]
    df = spark.createDataFrame(rows, "site string, ts timestamp_ntz, t double, p double")
    got = {r.kind: r for r in C.climate_periods(df, ["site"], "ts", 24).collect()}
    assert got["heat"]["mean"] == 2 and got["heat"].frequency == pytest.approx(2 / 40 * 365.25)
    assert got["dry"].frequency == 0 and got["wet"]["mean"] is None  # 2.4 a day, the same each day


def test_axes(spark):
    """Hourly axes with defaults, and the last day of leap years."""
    at = lambda h: dt.datetime(2000, 1, 1, h)
    df = spark.createDataFrame([("s", at(0), 1.0, "A", 1), ("s", at(1), None, "P", 1), ("s", at(3), 2.0, "A", 0)], "site string, ts timestamp_ntz, q double, quality string, is_ice int")
    got = [tuple(r)[1:] for r in T.reindex(df, ["site"], "ts", "1 HOUR", "q", ["is_ice"], ["quality"]).orderBy("ts").collect()]
    assert got == [(at(0), 1.0, "A", 1, 0), (at(1), None, None, 0, 0), (at(2), None, None, 0, 1), (at(3), 2.0, "A", 0, 0)]
    days = [dt.date(2004, 1, 1) + dt.timedelta(i) for i in range(800)]
    rows = [("s", d, float(i)) for i, d in enumerate(days) if (d.month, d.day, d.year) != (12, 31, 2004) and d != dt.date(2005, 3, 1)]
    got = T.add_leap_days(spark.createDataFrame(rows, "site string, day date, v double"), ["site"], "day", ["v"]).where("is_new = 1").collect()
    assert [(r.day, r.v, r.yearday) for r in got] == [(dt.date(2004, 12, 31), 365.0, 366)]
    assert O.wrap_latitude(spark.createDataFrame([(95.0,), (90.0,)], "lat double"), "lat").agg(F.sum("lat")).first()[0] == 5
