"""Streamflow signatures from daily flow. Columns: the site keys, day, q (mm/d); years are water years."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.scalars import circular_mean, circular_std, water_year
from rillflow.operators import scan
from rillflow.operators.shared import written
from rillflow.operators.timeseries import interpolate_time, period_stats

QUANTILES = (0.01, 0.05, 0.10, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def _years(q: DataFrame, keys: list[str], *aggs, day: str = "day") -> DataFrame:
    return q.groupBy(*keys, water_year(F.col(day)).alias("wy")).agg(*aggs)


def discharge_stats(q: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and population std of the annual means, and the number of years."""
    return _years(q, keys, F.avg("q").alias("m")).groupBy(*keys).agg(F.avg("m").alias("q_mean"), F.stddev_pop("m").alias("q_std"), F.count("m").alias("n_years"))


def runoff_ratio(q: DataFrame, p: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and std over years of mean q / mean p on the days that both have."""
    both = q.join(p, [*keys, "day"])
    return _years(both, keys, (F.avg("q") / F.avg("p")).alias("r")).groupBy(*keys).agg(F.avg("r").alias("ratio_mean"), F.stddev_pop("r").alias("ratio_std"))


def elasticity(q: DataFrame, p: DataFrame, keys: list[str]) -> DataFrame:
    """Median over years of ((Q - mean Q) / (P - mean P)) * (mean P / mean Q), from annual means."""
    years = _years(q.join(p, [*keys, "day"]), keys, F.avg("q").alias("q"), F.avg("p").alias("p"))
    w = Window.partitionBy(*keys)
    mq, mp = F.avg("q").over(w), F.avg("p").over(w)
    e = years.select(*keys, ((F.col("q") - mq) / F.nullif(F.col("p") - mp, F.lit(0.0)) * (mp / mq)).alias("e"))
    return e.groupBy(*keys).agg(F.median("e").alias("elasticity"))


def fdc_slope(q: DataFrame, keys: list[str]) -> DataFrame:
    """Slope of the flow-duration curve between 33 and 66 percent; zeros become a thousandth of the year's mean flow;
    years without any positive flow are left out."""
    w = Window.partitionBy(*keys, "wy")
    rows = q.where("q is not null").select(*keys, water_year(F.col("day")).alias("wy"), "q")
    rows = rows.withColumns({"m": F.avg("q").over(w), "any": F.max("q").over(w) > 0}).where("any")
    rows = rows.withColumn("ln", F.ln(F.when(F.col("q") == 0, F.col("m") / 1000).otherwise(F.col("q"))))
    years = rows.groupBy(*keys, "wy").agg(((F.percentile("ln", 0.66) - F.percentile("ln", 0.33)) / (0.66 - 0.33)).alias("s"))
    return years.groupBy(*keys).agg(F.avg("s").alias("slope_mean"), F.stddev_pop("s").alias("slope_std"))


def flow_quantiles(q: DataFrame, keys: list[str], at=QUANTILES) -> DataFrame:
    """Mean and std over years of each quantile, in rows (quantile, mean, std). Groups are years: exact is cheap."""
    years = _years(q, keys, F.percentile("q", F.array(*[F.lit(x) for x in at])).alias("v"))
    rows = years.select(*keys, F.posexplode("v").alias("i", "v"))
    out = rows.groupBy(*keys, "i").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    return out.select(*keys, F.get(F.array(*[F.lit(x) for x in at]), F.col("i")).alias("quantile"), "mean", "std")


def composed(a: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The composition of the maps 0..i, for every i: each map is b -> min(a b + c, d), with a >= 0, and two of them in turn
    are one of the same form. Doubling: after k rounds an entry holds the last 2^k maps."""
    a, c, d = a.copy(), c.copy(), d.copy()
    step = 1
    while step < len(a):
        late, soon = slice(step, None), slice(None, -step)
        top = np.minimum(np.where(a[late] == 0, 0.0, a[late] * d[soon]) + c[late], d[late])
        a[late], c[late], d[late] = a[late] * a[soon], a[late] * c[soon] + c[late], top
        step *= 2
    return a, c, d


def baseflow_eckhardt(q: DataFrame, keys: list[str], a: float = 0.98, bfi_max: float = 0.8) -> DataFrame:
    """q with b, the recursive digital filter's baseflow; gaps of q are interpolated for the recursion and masked.

    A step is b -> min(a b + c, d). Such maps compose, so a site's days are composed block by block; one map per block is
    composed along the site, and the days of each block are filled from what its block starts with, all in parallel.
    """
    kinds = {f.name: f.dataType.simpleString() for f in q.schema}
    by = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    t, width = scan.number_of(q, "day")
    x = F.col("_q").cast("double")
    rows = interpolate_time(q.select(*keys, "day", F.col("q").cast("double").alias("q")).withColumn("_q", F.col("q")), keys, "day", ["_q"]).where(x.isNotNull())
    rows = rows.select(*keys, "day", "q", "_q", t.alias("_at")).withColumn("_b", scan.block_of(F.col("_at"), width))
    first = rows.groupBy(*keys).agg(F.min("_at").alias("_first"))
    rows = written(rows.join(first, keys).withColumn("_first", F.col("_at") == F.col("_first")), "days")
    keep, gain = (1 - bfi_max) * a / (1 - a * bfi_max), (1 - a) * bfi_max / (1 - a * bfi_max)

    def maps(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flow, first = part["_q"].to_numpy(float), part["_first"].to_numpy(bool)
        return composed(np.where(first, 0.0, keep), np.where(first, bfi_max, gain) * flow, flow)

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        last = [m[-1:] for m in maps(part.sort_values("_at"))]
        return part[[*keys, "_b"]].head(1).assign(**dict(zip("acd", last, strict=True)))

    def starts(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_b")
        _, c, d = composed(*(part[k].to_numpy(float) for k in "acd"))  # the first map is constant, so a is 0
        return part[[*keys, "_b"]].assign(_in=np.concatenate([[0.0], np.minimum(c, d)[:-1]]))

    def filled(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_at")
        m, c, d = maps(part)
        b = np.minimum(m * part["_in"].to_numpy(float) + c, d)
        return part[[*keys, "day", "q"]].assign(b=np.where(part["q"].isna(), np.nan, b))

    one = rows.groupBy(*keys, "_b").applyInPandas(whole, f"{by}, _b long, a double, c double, d double")
    carry = one.groupBy(*keys).applyInPandas(starts, f"{by}, _b long, _in double")
    out = rows.join(carry, [*keys, "_b"]).groupBy(*keys, "_b").applyInPandas(filled, f"{by}, day {kinds['day']}, q double, b double")
    # Days before the first and after the last flow have none.
    outside = q.select(*keys, "day", F.col("q").cast("double").alias("q")).where("q is null")
    outside = outside.join(rows.where("q is null").select(*keys, "day"), [*keys, "day"], "left_anti")
    return out.withColumn("b", F.when(F.isnan("b"), None).otherwise(F.col("b"))).unionByName(outside.withColumn("b", F.lit(None).cast("double")))


def baseflow_index(q: DataFrame, keys: list[str], a: float = 0.98, bfi_max: float = 0.8) -> DataFrame:
    years = _years(baseflow_eckhardt(q, keys, a, bfi_max), keys, (F.avg("b") / F.avg("q")).alias("i"))
    return years.groupBy(*keys).agg(F.avg("i").alias("bfi_mean"), F.stddev_pop("i").alias("bfi_std"))


def half_flow(q: DataFrame, keys: list[str]) -> DataFrame:
    """The first day of each water year on which over half of its flow has passed; years without flow are left out."""
    w = Window.partitionBy(*keys, "wy").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = q.select(*keys, "day", "q", water_year(F.col("day")).alias("wy"))
    rows = rows.withColumns({"c": F.sum("q").over(w), "t": F.sum("q").over(Window.partitionBy(*keys, "wy"))})
    return rows.where("c / nullif(t, 0) > 0.5 and q is not null").groupBy(*keys, "wy").agg(F.min("day").alias("half_day"))


def half_flow_date(q: DataFrame, keys: list[str]) -> DataFrame:
    doy = F.dayofyear("half_day").cast("double")
    return half_flow(q, keys).groupBy(*keys).agg(circular_mean(doy, 366.0).alias("hfd_mean"), circular_std(doy, 366.0).alias("hfd_std"))


def flow_periods(q: DataFrame, keys: list[str]) -> DataFrame:
    """period_stats of no (<= 0), low (< 0.2 mean) and high (> 9 median) flow, in rows (kind, ...)."""
    per = q.groupBy(*keys).agg((0.2 * F.avg("q")).alias("_low"), (9 * F.median("q")).alias("_high"))
    rows = q.join(per, keys)
    kinds = {"no": F.col("q") <= 0, "low": F.col("q") < F.col("_low"), "high": F.col("q") > F.col("_high")}
    return period_stats(rows, keys, "day", kinds)
