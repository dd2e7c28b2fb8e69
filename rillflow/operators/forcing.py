"""Gridded forcing: merging, units, remapping to basins, and completeness checks.

Forcing tables are wide (one row per cell and time, one column per variable), so remapping never melts variables.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.operators import scan
from rillflow.operators.shared import written

#: Keys that a task compares, about.
KEYS = 1 << 19

# Fixed values: (variable, factor, offset) of each data set's conversion to kg m-2 s-1, Pa, K and m s-1.
RULES = {
    "RDRS": (("RDRS_v2.1_A_PR0_SFC", 1000 / 3600, 0.0), ("RDRS_v2.1_P_P0_SFC", 100.0, 0.0), ("RDRS_v2.1_P_TT_1.5m", 1.0, 273.15), ("RDRS_v2.1_P_UUC_10m", 0.514, 0.0), ("RDRS_v2.1_P_VVC_10m", 0.514, 0.0), ("RDRS_v2.1_P_UVC_10m", 0.514, 0.0)),
    "EM-Earth": (("tmean", 1.0, 273.15), ("prcp", 1 / 3600, 0.0)),
    "Daymet": (("srad", 1000 / 86400, 0.0),),
}
GRIDS = {"ERA5": 0.25, "EM-Earth": 0.05}


def convert_units(df: DataFrame, rules) -> DataFrame:
    """Each rule (column, factor, offset) replaces the column by factor * value + offset."""
    return df.withColumns({v: F.col(f"`{v}`") * F.lit(float(m)) + F.lit(float(a)) for v, m, a in rules if v in df.columns})


def mask_values(df: DataFrame, cols: list[str], nodata: float | None = None, low: float | None = None, high: float | None = None, mode: str = "mask") -> DataFrame:
    """nodata to null; values outside [low, high] to null (mask) or to the bound (clamp)."""
    made = {}
    for c in cols:
        v = F.when(F.col(c) == nodata, None).otherwise(F.col(c)) if nodata is not None else F.col(c)
        for bound, pick, over in ((low, F.greatest, lambda v, b: v < b), (high, F.least, lambda v, b: v > b)):
            if bound is not None:
                v = F.when(v.isNull(), None).otherwise(pick(v, F.lit(float(bound)))) if mode == "clamp" else F.when(over(v, bound), None).otherwise(v)
        made[c] = v
    return df.withColumns(made)


def missing_partners(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, with the side: empty if the two may be merged. A null in a key matches nothing.

    Keys of both sides are dealt to parts of about KEYS rows and counted there once, so a task holds no more of them however
    many there are."""
    side = lambda df, left: df.select(*keys, F.lit(left).alias("_left"))
    rows = written(side(a, True).unionByName(side(b, False)), "keys")
    dealt = rows.repartition(min(rows.count() // KEYS + 1, 1 << 14), *keys)
    both = dealt.groupBy(*keys).agg(F.max("_left").alias("_a"), F.max(~F.col("_left")).alias("_b"))
    known = functools.reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    sides = F.array_compact(F.array(F.when(F.col("_a") & ~(known & F.col("_b")), F.lit("left")), F.when(F.col("_b") & ~(known & F.col("_a")), F.lit("right"))))
    return both.select(*keys, F.explode(sides).alias("side"))


def merge_vars(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One wide row per key that both sides have."""
    return a.join(b, keys)


def align_coords(df: DataFrame, ref: DataFrame, coords: list[str], tolerance: float = 1e-4) -> DataFrame:
    """Coordinates take those of the nearest reference that is within the tolerance in each of them (ties: the smallest);
    rows without one go, every other row stays one row.

    Both sides meet in cells as wide as the tolerance. References are in the cells around theirs too, so no pair is lost
    at a cell's edge. Each coordinate of df is looked up once, however many rows have it.
    """
    cell = lambda c: F.floor(F.col(c) / tolerance)
    r = ref.select(*[F.col(c).alias(f"ref_{c}") for c in coords]).distinct()
    for c in coords:
        r = r.withColumn(f"_{c}", F.explode(F.array(*[cell(f"ref_{c}") + i for i in (-1, 0, 1)])))
    own = df.select(*coords).distinct().withColumns({f"_{c}": cell(c) for c in coords}).join(r, [f"_{c}" for c in coords])
    off = {c: F.abs(F.col(c) - F.col(f"ref_{c}")) for c in coords}
    for d in off.values():
        own = own.where(d <= tolerance)
    squares = sum((d * d for d in off.values()), F.lit(0.0))
    to = F.struct(*[F.col(f"ref_{c}").alias(c) for c in coords])
    best = own.groupBy(*coords).agg(F.min_by(to, F.struct(squares, to)).alias("_to"))
    return df.join(best, coords).withColumns({c: F.col(f"_to.{c}") for c in coords}).drop("_to").select(*df.columns)


def remap(forcing: DataFrame, weights: DataFrame, variables: list[str], time: list[str]) -> DataFrame:
    """hru, time, and each variable's weighted mean over the hru's cells: sum(w v) / sum(w) of the cells with a value.

    The join key is the cell; sums are partial before the shuffle, and the shuffle key (hru, time) keeps one giant
    basin or one hru's decades out of a single task. Spark broadcasts the weights where they are small.
    """
    rows = forcing.join(weights, "cell")
    w = lambda v: F.sum(F.when(F.col(v).isNotNull(), F.col("w")))
    return rows.groupBy("hru", *time).agg(*[(F.sum(F.col("w") * F.col(v)) / F.nullif(w(v), F.lit(0.0))).alias(v) for v in variables])


def add_elevation(cells: DataFrame, invariants: DataFrame, coords: list[str]) -> DataFrame:
    """elevation of each cell from the geopotential at exactly its coordinates."""
    return cells.join(invariants.select(*coords, (F.col("z") / 9.80665).alias("elevation")), coords, "left")


def snap_bbox(df: DataFrame, product: str) -> DataFrame:
    """Bounding boxes (west, south, east, north) widened to a product's grid by the half-cell rule."""
    g = GRIDS[product]
    down, up = (lambda c: F.floor((F.col(c) - g / 2) / g) * g + 0.0), (lambda c: F.ceil((F.col(c) + g / 2) / g) * g + 0.0)
    return df.withColumns({"west": down("west"), "south": down("south"), "east": up("east"), "north": up("north")})


def wrap_latitude(df: DataFrame, lat: str) -> DataFrame:
    """Latitudes over 90 less 180, as files with another origin count them."""
    return df.withColumn(lat, F.when(F.col(lat) > 90, F.col(lat) - 180).otherwise(F.col(lat)))


def wrap_longitude(df: DataFrame, lon: str) -> DataFrame:
    """0..360 to -180..180."""
    return df.withColumn(lon, F.when(F.col(lon) > 180, F.col(lon) - 360).otherwise(F.col(lon)))


def bbox_filter(cells: DataFrame, boxes: DataFrame, key: str, bucket: float = 1.0) -> DataFrame:
    """(key, cell columns) of cells inside each box; both sides meet on whole-degree buckets, not by a theta join."""
    b = boxes.withColumn("_bx", F.explode(F.sequence(F.floor(F.col("west") / bucket), F.floor(F.col("east") / bucket)))).withColumn("_by", F.explode(F.sequence(F.floor(F.col("south") / bucket), F.floor(F.col("north") / bucket))))
    c = cells.withColumn("_bx", F.floor(F.col("lon") / bucket)).withColumn("_by", F.floor(F.col("lat") / bucket))
    hit = c.join(b, ["_bx", "_by"]).where("lon between west and east and lat between south and north")
    return hit.select(key, *cells.columns)


def month_periods(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month that the period touches, with its first and last day inside the period."""
    rows = df.withColumn("_m", F.explode(F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))))
    return rows.withColumns({"month_start": F.greatest(F.col("_m"), F.col(start)), "month_end": F.least(F.last_day("_m"), F.col(end))}).drop("_m")


def time_steps(df: DataFrame, keys: list[str], ts: str, step_seconds: int, hru: str | None = None) -> DataFrame:
    """keys and _gap, whether two times of a series (of any of its hrus) that follow each other are not one step apart.
    Blocks of a series are looked at by themselves, and then the steps between blocks."""
    by = [*keys, *([hru] if hru else [])]
    rows = df.select(*by, F.unix_seconds(F.col(ts).cast("timestamp")).alias("_t"))
    rows = rows.withColumn("_b", scan.block_of(F.col("_t") * 1_000_000, scan.MICROS))
    inside = F.col("_t") - F.lag("_t").over(Window.partitionBy(*by, "_b").orderBy("_t")) != step_seconds
    blocks = rows.withColumn("_gap", inside).groupBy(*by, "_b").agg(F.coalesce(F.bool_or("_gap"), F.lit(False)).alias("_gap"), F.min("_t").alias("_a"), F.max("_t").alias("_z"))
    between = F.coalesce(F.col("_a") - F.lag("_z").over(Window.partitionBy(*by).orderBy("_b")) != step_seconds, F.lit(False))
    return blocks.withColumn("_gap", F.col("_gap") | between).groupBy(*keys).agg(F.bool_or("_gap").alias("_gap"))


def check_forcing(df: DataFrame, keys: list[str], ts: str, required: list[str], step_seconds: int = 3600, null_ratio: float = 1e-4, lumped: bool = False, hru: str | None = None, months: bool = False) -> DataFrame:
    """(keys, reason) of every check that a series fails: no data, missing values, several hrus, time gaps, start at
    midnight (still UTC), a required variable that the table lacks, and (months) a month without data between the first
    and the last one."""
    absent, required = [c for c in required if c not in df.columns], [c for c in required if c in df.columns]
    checks = {f"nulls in {c}": F.avg(F.col(c).isNull().cast("double")) >= null_ratio for c in required}
    checks |= {f"no data in {c}": F.count(c) == 0 for c in required}
    checks |= {f"absent {c}": F.count("*") > 0 for c in absent}
    if months:
        month = F.trunc(F.col(ts).cast("date"), "month")
        checks |= {"missing months": F.count_distinct(month) <= F.months_between(F.max(month), F.min(month))}
    checks |= {"starts at midnight": F.hour(F.min(ts)) == 0}
    if lumped and hru:
        checks |= {"more than one hru": F.count_distinct(hru) > 1}
    per = df.groupBy(*keys).agg(*[c.alias(f"_c{i}") for i, c in enumerate(checks.values())])
    reasons = [F.when(F.col(f"_c{i}"), F.lit(k)) for i, k in enumerate(checks)] + [F.when(F.col("_gap"), F.lit("time steps"))]
    rows = per.join(time_steps(df, keys, ts, step_seconds, hru), keys, "left")
    return rows.select(*keys, F.explode(F.array_compact(F.array(*reasons))).alias("reason"))


def unequal_periods(parts: DataFrame, basin: str, part: str, ts: str) -> DataFrame:
    """Basins whose parts (gridded, lumped, distributed) differ in first or last time or number of times."""
    per = parts.groupBy(basin, part).agg(F.min(ts).alias("a"), F.max(ts).alias("z"), F.count_distinct(ts).alias("n"))
    return per.groupBy(basin).agg(F.count_distinct("a", "z", "n").alias("versions")).where("versions > 1").select(basin, F.lit("periods differ").alias("reason"))


def reason_counts(log: DataFrame, basin: str) -> DataFrame:
    """How often each reason occurs, and for how many basins."""
    return log.groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct(basin).alias("n_basins"))


def compare_categories(old: DataFrame, new: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Per key: how many times both have, and at how many of them the text differs (null is the empty text)."""
    text = lambda c: F.coalesce(F.col(value).cast("string"), F.lit("")).alias(c)
    both = old.select(*keys, ts, text("a")).join(new.select(*keys, ts, text("b")), [*keys, ts])
    return both.groupBy(*keys).agg(F.count("*").alias("n_common"), F.count_if(F.col("a") != F.col("b")).alias("n_different"))


def compare_series(old: DataFrame, new: DataFrame, keys: list[str], ts: str, value: str, absolute: float = 0.1, relative: float = 0.01) -> DataFrame:
    """Per key: common, missing and added times; counts above the thresholds; mean, maximum and 95th percentile of the
    exceeding differences; ratios of means and stds; correlation."""
    both = old.select(*keys, ts, F.col(value).alias("a"), F.lit(1).alias("_o")).join(new.select(*keys, ts, F.col(value).alias("b"), F.lit(1).alias("_n")), [*keys, ts], "full_outer")
    d = F.abs(F.col("b") - F.col("a"))
    over = F.when(d > absolute, d)
    pair = F.col("a").isNotNull() & F.col("b").isNotNull()
    a, b = F.when(pair, F.col("a")), F.when(pair, F.col("b"))
    return both.groupBy(*keys).agg(
        F.count_if(F.col("_o").isNotNull() & F.col("_n").isNotNull()).alias("n_common"), F.count_if(F.col("_n").isNull()).alias("n_missing"), F.count_if(F.col("_o").isNull()).alias("n_added"),
        F.count_if(d > absolute).alias("n_absolute"), F.count_if(d > F.abs("a") * relative).alias("n_relative"),
        F.avg(over).alias("mean_over"), F.max(over).alias("max_over"), F.percentile(over, 0.95).alias("p95_over"),
        (F.avg(b) / F.nullif(F.avg(a), F.lit(0.0))).alias("mean_ratio"), (F.stddev_pop(b) / F.nullif(F.stddev_pop(a), F.lit(0.0))).alias("std_ratio"), F.corr(a, b).alias("correlation"),
    )
