"""Scans in blocks: the same rows whatever the blocks, and a long site over many tasks."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.operators import scan
from rillflow.operators import signatures as G
from rillflow.operators import timeseries as T

DAY0, TS0 = dt.date(1999, 12, 1), dt.datetime(1999, 12, 30, 22, 10)


def days(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(s, DAY0 + dt.timedelta(i), None if rng.random() < 0.2 else rng.expovariate(1)) for s in "ab" for i in range(n) if rng.random() < 0.9]
    return spark.createDataFrame(rows + [("c", DAY0, None), ("d", DAY0, 2.0)], "site string, day date, q double")


def observed(spark, n=300):
    rng, rows = random.Random(2), []
    for s in "ab":
        at = TS0
        for _ in range(n):
            at += dt.timedelta(minutes=rng.choice([5, 15, 20, 30, 30, 60, 170]))
            rows.append((s, at, None if rng.random() < 0.05 else rng.uniform(0, 9)))
    return spark.createDataFrame([*rows, ("c", TS0, 1.0)], "site string, ts timestamp_ntz, value double")


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        for u, v in zip(x, y, strict=True):
            assert u == v or (isinstance(u, float) and u == pytest.approx(v, rel=1e-9, abs=1e-12)), (x, y)


def test_blocks_do_not_matter(spark, monkeypatch):
    """Gaps, runs, statistics, hours and baseflow with blocks of a few rows as with one block."""
    q, o = days(spark).cache(), observed(spark).cache()

    def all_of():
        yield T.interpolate_time(q, ["site"], "day", ["q"])
        yield T.run_lengths(q, ["site"], "day", F.col("q") > 0.7)
        yield T.run_lengths(q, ["site"], "day", F.col("q").isNull() | (F.col("q") < 3), include_open=True)
        yield T.period_stats(q, ["site"], "day", {"high": F.col("q") > 1, "all": F.lit(True)})
        yield T.resample_hourly(o, ["site"], "ts", "value")
        yield T.resample_hourly(o, ["site"], "ts", "value", True)
        yield T.fill_edges(T.half_hour_marks(o, ["site"], "ts", "value")[0], ["site"], True)
        yield G.baseflow_eckhardt(q, ["site"])

    results = []
    for d, micros in ((1024, 64 * 86_400_000_000), (9, 6 * 3_600_000_000)):
        monkeypatch.setattr(scan, "DAYS", d)
        monkeypatch.setattr(scan, "MICROS", micros)
        results.append([sorted_rows(df) for df in all_of()])
    for one, many in zip(*results, strict=True):
        assert one
        same(one, many)


def plain_filter(flow, a=0.98, bfi=0.8):
    out, last = [], None
    for x in flow:
        b = x * bfi if last is None else ((1 - bfi) * a * last + (1 - a) * bfi * x) / (1 - a * bfi)
        last = min(b, x)
        out.append(last)
    return out


def test_parallel_filter(spark):
    """The composed maps give the recursion's values, for any block."""
    rng = np.random.default_rng(3)
    flow = rng.gamma(0.5, 2, 3000)
    want = plain_filter(flow.tolist())
    rows = [("s", DAY0 + dt.timedelta(i), float(x)) for i, x in enumerate(flow)]
    got = G.baseflow_eckhardt(spark.createDataFrame(rows, "site string, day date, q double"), ["site"]).orderBy("day").collect()
    assert [r.b for r in got] == pytest.approx(want, rel=1e-9)
    hours = [("s", TS0 + dt.timedelta(hours=i), float(x)) for i, x in enumerate(flow)]
    got = G.baseflow_eckhardt(spark.createDataFrame(hours, "site string, day timestamp_ntz, q double"), ["site"]).orderBy("day").collect()
    assert [r.b for r in got] == pytest.approx(want, rel=1e-9)


def test_a_long_site_is_spread(spark):
    """A century of one site lies in many blocks, each of bounded length; only one row of each meets in the site's window."""
    df = spark.sql("SELECT 's' AS site, explode(sequence(DATE'1900-01-01', DATE'1999-12-31')) AS day").withColumn("q", F.rand(1))
    t, width = scan.number_of(df, "day")
    sizes = df.groupBy(scan.block_of(t, width)).count().collect()
    assert len(sizes) > 30 and max(r["count"] for r in sizes) <= scan.DAYS
    plan = G.baseflow_eckhardt(df, ["site"])._jdf.queryExecution().executedPlan().toString()
    assert "_b" in plan and T.interpolate_time(df, ["site"], "day", ["q"]).count() == df.count()
