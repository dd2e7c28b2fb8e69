"""Rasters as pixel tables: (layer, row, col, value), zones (row, col, zone)."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rillflow.functions.scalars import FREEZING, conductivity, porosity
from rillflow.operators import mergeable as M


def zonal_stats(pixels: DataFrame, keys: list[str], value: str = "value", extra: dict[str, Column] | None = None, functions: dict[str, Callable] | None = None, empty: float | None = None, mergeable: dict[str, M.Mergeable] | None = None) -> DataFrame:
    """min, mean, max, std, harmonic mean and count per zone and layer, and what a user adds: aggregate expressions
    (extra), or functions from the zone's values as a pandas Series to a number; a zone without valid pixels gets
    `empty`. A function sees a whole zone in one task: give an expression where there is one, or a mergeable aggregate,
    of which only states travel."""
    v = F.col(value)
    stats = {"min": F.min(v), "mean": F.avg(v), "max": F.max(v), "std": F.stddev_pop(v), "harmonic_mean": F.count(v) / F.nullif(F.sum(1 / F.nullif(v, F.lit(0.0))), F.lit(0.0))} | (extra or {})
    filled = [(F.coalesce(c, F.lit(empty)) if empty is not None else c).alias(k) for k, c in stats.items()]
    out = pixels.groupBy(*keys).agg(*filled, F.count(v).alias("n"))
    for k, f in (mergeable or {}).items():
        own = M.aggregate(pixels.where(v.isNotNull()), keys, value, {k: f})
        out = out.join(own, keys, "left").withColumns({k: F.coalesce(k, F.lit(empty))} if empty is not None else {})
    if not functions:
        return out
    made = [F.pandas_udf(f, "double", F.PandasUDFType.GROUPED_AGG)(v.cast("double")).alias(k) for k, f in functions.items()]
    own = pixels.where(v.isNotNull()).groupBy(*keys).agg(*made)
    return out.join(own, keys, "left").withColumns({k: F.coalesce(k, F.lit(empty)) for k in functions} if empty is not None else {})


def class_fractions(pixels: DataFrame, zone: str, legend: list[int] | dict[int, str], value: str = "value", prefix: str = "") -> DataFrame:
    """zone, class, fraction for every class of the legend, absent ones 0; values outside it count in the total. A
    legend with names adds attribute: <prefix><name>_fraction."""
    counts = pixels.where(F.col(value).isNotNull()).groupBy(zone, F.col(value).cast("int").alias("class")).agg(F.count("*").alias("n"))
    total = counts.groupBy(zone).agg(F.sum("n").alias("t"))
    grid = total.withColumn("class", F.explode(F.array(*[F.lit(c) for c in legend])))
    out = grid.join(counts, [zone, "class"], "left").select(zone, "class", (F.coalesce("n", F.lit(0)) / F.col("t")).alias("fraction"))
    if not isinstance(legend, dict):
        return out
    names = F.create_map(*[F.lit(x) for k, n in legend.items() for x in (k, f"{prefix}{n}_fraction")])
    return out.withColumn("attribute", F.element_at(names, F.col("class")))


def stack_composite(pixels: DataFrame, how: str, keys: list[str], value: str = "value", low: float | None = None, high: float | None = None) -> DataFrame:
    """One value per pixel (and further keys) over the dates of a stack: mean or sum of valid values, or the most
    frequent one, of equally frequent ones the lowest."""
    valid = F.lit(True) if low is None else F.col(value).between(low, high)
    rows = pixels.where(valid & F.col(value).isNotNull())
    if how == "mode":
        counts = rows.groupBy(*keys, value).agg(F.count("*").alias("_n"))
        return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))
    return rows.groupBy(*keys).agg((F.avg(value) if how == "mean" else F.sum(value)).alias(value))


def apply_scale(stats: DataFrame, layers: DataFrame, means: list[str], spreads: list[str]) -> DataFrame:
    """Scale and offset of the layer (none: 1 and 0) on statistics; spreads take the scale's size only."""
    s, o = F.coalesce("scale", F.lit(1.0)), F.coalesce("offset", F.lit(0.0))
    rows = stats.join(layers.select("layer", "scale", "offset"), "layer", "left")
    return rows.withColumns({c: F.col(c) * s + o for c in means} | {c: F.col(c) * F.abs(s) for c in spreads}).drop("scale", "offset")


def mosaic(tiles: DataFrame, rank: str, window: tuple[int, int, int, int]) -> DataFrame:
    """Tiles into one extent (row0, row1, col0, col1, ends excluded): of overlapping pixels the last tile's wins."""
    r0, r1, c0, c1 = window
    inside = tiles.where((F.col("row") >= r0) & (F.col("row") < r1) & (F.col("col") >= c0) & (F.col("col") < c1))
    return inside.groupBy("row", "col").agg(F.max_by("value", rank).alias("value"))


def halo_blocks(pixels: DataFrame, keys: list[str], side: int) -> DataFrame:
    """keys, br, bc, rows, cols, values: one row per square block of pixels, with a border of one pixel from the blocks
    around it. A pixel inside a block is in it alone; one on its border also in those it borders on, so there are some
    1 + 4 / side copies of a pixel."""
    at = {c: F.array_distinct(F.array(*[F.floor((F.col(c) + d) / side) for d in (-1, 0, 1)])) for c in ("row", "col")}
    dealt = pixels.where("value is not null").withColumn("br", F.explode(at["row"])).withColumn("bc", F.explode(at["col"]))
    return dealt.groupBy(*keys, "br", "bc").agg(F.collect_list(F.struct(F.col("row").cast("long"), F.col("col").cast("long"), F.col("value").cast("double"))).alias("p"))


def horn(z: np.ndarray, cell_x: float, cell_y: float) -> tuple[np.ndarray, np.ndarray]:
    """Slope and aspect of the inner pixels of an array with a border of one; nan is missing."""
    n, m = z.shape[0] - 2, z.shape[1] - 2
    own = {(dr, dc): z[1 + dr : 1 + dr + n, 1 + dc : 1 + dc + m] for dr in (-1, 0, 1) for dc in (-1, 0, 1)}
    first = lambda *some: functools.reduce(lambda a, b: np.where(np.isnan(a), b, a), some)
    c, v = own[0, 0], {}
    for o in ((-1, 0), (1, 0), (0, -1), (0, 1)):
        v[o] = first(own[o], 2 * c - own[-o[0], -o[1]], c)
    for dr, dc in ((-1, -1), (-1, 1), (1, -1), (1, 1)):
        v[dr, dc] = first(own[dr, dc], v[dr, 0] + v[0, dc] - c)
    dx = (v[-1, 1] + 2 * v[0, 1] + v[1, 1] - v[-1, -1] - 2 * v[0, -1] - v[1, -1]) / (8 * cell_x)
    dy = (v[1, -1] + 2 * v[1, 0] + v[1, 1] - v[-1, -1] - 2 * v[-1, 0] - v[-1, 1]) / (8 * cell_y)
    aspect = np.where((dx != 0) | (dy != 0), np.mod(np.degrees(np.arctan2(-dx, dy)), 360.0), np.nan)
    return np.degrees(np.arctan(np.sqrt(dx * dx + dy * dy))), aspect


def terrain(pixels: DataFrame, keys: list[str], cell_x: float = 1.0, cell_y: float = 1.0, side: int = 64) -> DataFrame:
    """Slope and aspect in degrees by Horn's 3 x 3 window (aspect: the downhill direction from north).

    Pixels travel as blocks with a border of one pixel, and a block is one array. A missing side neighbour is extrapolated
    from the centre and the opposite one (2 c - o; where that is missing too, it takes the centre), a missing corner from
    the two sides next to it. Of a pixel that comes twice the largest value counts.
    """
    blocks = halo_blocks(pixels, keys, side)
    kinds = [f"`{k}` {pixels.schema[k].dataType.simpleString()}" for k in [*keys, "row", "col"]]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, starts = batch.column("p"), [batch.column(c).to_pylist() for c in ("br", "bc")]
            offsets, (row, col, value) = p.offsets.to_numpy(), (c.to_numpy() for c in p.values.flatten())
            for i, (br, bc) in enumerate(zip(*starts, strict=True)):
                a, e = offsets[i], offsets[i + 1]
                z = np.full((side + 2, side + 2), np.nan)
                np.fmax.at(z, (row[a:e] - br * side + 1, col[a:e] - bc * side + 1), value[a:e])
                slope, aspect = horn(z, cell_x, cell_y)
                r, c = np.nonzero(~np.isnan(z[1:-1, 1:-1]))
                if len(r):
                    made = [pa.array(r + br * side), pa.array(c + bc * side), pa.array(z[r + 1, c + 1]), pa.array(slope[r, c]), pa.array(aspect[r, c], from_pandas=True)]
                    made = [x.cast(t) for x, t in zip(made, types, strict=True)]
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(np.full(len(r), i))) for k in keys), *made], names=[*keys, "row", "col", "value", "slope", "aspect"])

    types = [*(to_arrow_type(pixels.schema[c].dataType) for c in ("row", "col")), *[pa.float64()] * 3]
    return blocks.mapInArrow(apply, ", ".join([*kinds, "value double", "slope double", "aspect double"]))


def soil_properties(pixels: DataFrame) -> DataFrame:
    """porosity and conductivity from columns sand and clay (per mille)."""
    return pixels.withColumns({"porosity": porosity(F.col("sand"), F.col("clay")), "conductivity": conductivity(F.col("sand"), F.col("clay"))})


def gridded_climate(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Annual aridity, snow and snow fraction per pixel from twelve months of p, pet (mm) and t (C), and seasonality of
    the twelve values; zero precipitation counts as 1 mm."""
    x = 2 * math.pi * (F.col("month") - 1) / 12
    part = lambda v, f: 2 * F.avg(F.col(v) * f(x))
    amplitude = F.sqrt(F.pow(part("t", F.sin), 2.0) + F.pow(part("t", F.cos), 2.0))
    p = F.when(F.sum("p") == 0, 1.0).otherwise(F.sum("p"))
    snow = F.sum(F.when(F.col("t") < 0, F.col("p")).otherwise(0.0))
    index = (part("p", F.sin) * part("t", F.sin) + part("p", F.cos) * part("t", F.cos)) / F.nullif(F.avg("p") * amplitude, F.lit(0.0))
    return pixels.groupBy(*keys).agg((F.sum("pet") / p).alias("aridity"), snow.alias("snow"), (snow / p).alias("fsnow"), index.alias("seasonality"))


def deviating_layers(layers: DataFrame, basin: str, profile: list[str]) -> DataFrame:
    """Layers whose profile (extent, type and so on) isn't the basin's most common one (ties: the first by value)."""
    counts = layers.groupBy(basin, *profile).agg(F.count("*").alias("_n"))
    first = Window.partitionBy(basin).orderBy(F.desc("_n"), *profile)
    common = counts.withColumn("_r", F.row_number().over(first)).where("_r = 1").select(basin, *profile)
    return layers.join(common, [basin, *profile], "left_anti")


def weighted_stats(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """min, mean, max and std weighted by area over rows with a value."""
    rows = df.where(F.col(value).isNotNull() & F.col(weight).isNotNull())
    m = F.sum(F.col(value) * F.col(weight)) / F.sum(weight)
    second = F.sum(F.col(value) * F.col(value) * F.col(weight)) / F.sum(weight)
    return rows.groupBy(*keys).agg(F.min(value).alias("min"), m.alias("mean"), F.max(value).alias("max"), F.sqrt(F.greatest(second - m * m, F.lit(0.0))).alias("std"))


def open_water_stats(lakes: DataFrame, basins: DataFrame, key: str) -> DataFrame:
    """Counts (all, reservoirs: type 2) and statistics of area and volume; zeros for basins without lakes."""
    stats = [f(c).alias(f"{c}_{n}") for c in ("area", "volume") for n, f in (("min", F.min), ("mean", F.avg), ("max", F.max), ("std", F.stddev_samp), ("total", F.sum))]
    per = lakes.groupBy(key).agg(F.count("*").alias("n_lakes"), F.count_if(F.col("type") == 2).alias("n_reservoirs"), *stats)
    rows = basins.select(key).distinct().join(per, key, "left")
    return rows.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in per.columns if c != key])


def below_freezing(t: Column) -> Column:
    return t < FREEZING
