"""Climate attributes from daily or hourly forcing: keys, day, p (mm/d), t (K), pet (mm/d)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.scalars import DAYS_PER_YEAR, FREEZING
from rillflow.operators.timeseries import mean_daily_max, period_stats


def annual_climate(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and std over years of p, pet (mm/yr) and t, of aridity pet/p and of the snow fraction of p (t < 0 C)."""
    y = df.groupBy(*keys, F.year("day").alias("y")).agg((F.avg("p") * DAYS_PER_YEAR).alias("p"), (F.avg("pet") * DAYS_PER_YEAR).alias("pet"), F.avg("t").alias("t"), (F.avg(F.when(F.col("t") < FREEZING, F.col("p")).otherwise(0.0)) * DAYS_PER_YEAR).alias("snow"))
    y = y.withColumns({"aridity": F.col("pet") / F.nullif("p", F.lit(0.0)), "fsnow": F.col("snow") / F.nullif("p", F.lit(0.0))})
    return y.groupBy(*keys).agg(F.count("*").alias("n_years"), *[f(c).alias(f"{c}_{n}") for c in ("p", "pet", "t", "aridity", "fsnow") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def monthly_climatology(df: DataFrame, keys: list[str], value: str, factor: float = 1.0) -> DataFrame:
    """Per calendar month: mean and std over years of the month's mean of the daily mean, minimum and maximum."""
    d = df.groupBy(*keys, F.to_date("day").alias("d")).agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    ym = d.groupBy(*keys, F.year("d").alias("y"), F.month("d").alias("month")).agg(*[(F.avg(c) * factor).alias(c) for c in ("mean", "min", "max")])
    return ym.groupBy(*keys, "month").agg(*[f(c).alias(f"{c}_{n}") for c in ("mean", "min", "max") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def monthly_ratio(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per calendar month: mean and std over years of aridity and snow fraction; months without p count 1 mm."""
    ym = df.groupBy(*keys, F.year("day").alias("y"), F.month("day").alias("month")).agg(F.sum("p").alias("p"), F.sum("pet").alias("pet"), F.sum(F.when(F.col("t") < FREEZING, F.col("p")).otherwise(0.0)).alias("snow"))
    p = F.when(F.col("p") == 0, 1.0).otherwise(F.col("p"))
    ym = ym.withColumns({"aridity": F.col("pet") / p, "fsnow": F.col("snow") / p})
    return ym.groupBy(*keys, "month").agg(*[f(c).alias(f"{c}_{n}") for c in ("aridity", "fsnow") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def seasonality(df: DataFrame, keys: list[str], typical: bool = False) -> DataFrame:
    """Seasonality index in [-1, 1] per year (or of one typical year by day of year), then mean and std over years.

    Sines are fitted to daily t and p. On a gap-free year the least squares are the Fourier sums, so the index is
    (Ap At + Bp Bt) / (mean p * amplitude of t). A year with gaps has none.
    """
    rows = df.select(*keys, F.year("day").alias("y"), F.dayofyear("day").alias("i"), F.col("p").cast("double").alias("p"), F.col("t").cast("double").alias("t"))
    if typical:
        rows = rows.groupBy(*keys, F.lit(0).alias("y"), "i").agg(F.avg("p").alias("p"), F.avg("t").alias("t"))
    n = F.dayofyear(F.make_date("y", F.lit(12), F.lit(31))) if not typical else F.max("i").over(Window.partitionBy(*keys, "y"))
    rows = rows.withColumn("n", n).withColumn("x", 2 * math.pi * (F.col("i") - 1) / F.col("n"))
    part = lambda v, f: (2 * F.avg(F.col(v) * f("x"))).alias(f"{f.__name__}_{v}")
    y = rows.groupBy(*keys, "y").agg(F.count("p").alias("c"), F.count("t").alias("ct"), F.max("n").alias("n"), F.avg("p").alias("m"), part("p", F.sin), part("p", F.cos), part("t", F.sin), part("t", F.cos))
    amplitude = F.sqrt(F.col("sin_t") * F.col("sin_t") + F.col("cos_t") * F.col("cos_t"))
    index = (F.col("sin_p") * F.col("sin_t") + F.col("cos_p") * F.col("cos_t")) / F.nullif(F.col("m") * amplitude, F.lit(0.0))
    y = y.withColumn("s", F.when((F.col("c") == F.col("n")) & (F.col("ct") == F.col("n")), index))
    return y.groupBy(*keys).agg(F.avg("s").alias("seasonality_mean"), F.stddev_pop("s").alias("seasonality_std"), F.count("s").alias("n_years"))


def climate_periods(df: DataFrame, keys: list[str], ts: str = "day", steps_per_day: int = 1) -> DataFrame:
    """period_stats in rows (kind, ...): frost (steps with t < 0 C), heat (all steps of a day any of which is over the
    day's mean maximum plus 5 K), dry (days with p < 1) and wet (days with p >= 5 times their mean); p is summed by day.
    Without any run the four statistics are null. Lengths are in days whatever the step."""
    day = F.to_date(ts).alias("_day")
    daily = df.groupBy(*keys, day).agg(F.sum("p").alias("_p"), F.max("t").alias("_t"))
    mean = daily.groupBy(*keys).agg(F.avg("_p").alias("_mp"))
    dry = period_stats(daily.join(mean, keys), keys, "_day", {"dry": F.col("_p") < 1, "wet": F.col("_p") >= 5 * F.col("_mp")}, empty=None)
    hot = mean_daily_max(daily, keys, "_day", "_t").select(*keys, "_day", (F.col("_t") > F.col("mean_max") + 5).alias("_hot"))
    rows = df.select(*keys, ts, "t", day).join(hot, [*keys, "_day"])
    return period_stats(rows, keys, ts, {"frost": F.col("t") < FREEZING, "heat": F.col("_hot")}, steps_per_day, None).unionByName(dry)


def pet_comparison(sources: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Per source (keys, day, p, pet): long-term means, mean of annual means, aridity and number of negative pet."""
    out = None
    for name, df in sources.items():
        y = df.groupBy(*keys, F.year("day").alias("y")).agg(F.avg("pet").alias("a"))
        annual = y.groupBy(*keys).agg(F.avg("a").alias("pet_annual"))
        whole = df.groupBy(*keys).agg(F.avg("pet").alias("pet_mean"), F.avg("p").alias("p_mean"), F.count_if(F.col("pet") < 0).alias("n_negative"))
        one = whole.join(annual, keys).withColumn("aridity", F.col("pet_mean") / F.nullif("p_mean", F.lit(0.0))).withColumn("source", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out
