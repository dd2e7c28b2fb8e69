"""Polygons and lines as vertex arrays: geometry ARRAY<STRUCT<ring INT, x DOUBLE, y DOUBLE>>, rings not closed; holes
run the other way round than the ring around them.

Polygons meet points, cells and each other as leaves of a quadtree (`quadtree`), and pixels as runs of scan lines
(`scanline`). Areas, lengths and distances are column expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.scalars import albers
from rillflow.operators import nearest, quadtree, scanline

TINY_KM2 = 0.0005


def _bounds(df: DataFrame) -> DataFrame:
    xs, ys = F.transform("geometry", lambda v: v["x"]), F.transform("geometry", lambda v: v["y"])
    return df.withColumns({"_x0": F.array_min(xs), "_x1": F.array_max(xs), "_y0": F.array_min(ys), "_y1": F.array_max(ys)})


def point_in_polygon(points: DataFrame, polys: DataFrame, bucket: float = 1.0) -> DataFrame:
    """(point columns, poly_id) of each point in each polygon that contains it. points: id, x, y; polys: poly_id, geometry.
    A point on a west or south side is in, on an east or north side out."""
    return quadtree.in_polygons(points, polys, "poly_id", bucket)


def make_weights(cells: DataFrame, polys: DataFrame, half: float, bucket: float = 1.0) -> DataFrame:
    """hru, cell, weight: the share of each polygon's covered area in each grid cell (centre x, y and half spacing)."""
    c = cells.select("cell", (F.col("x") - half).alias("rx0"), (F.col("y") - half).alias("ry0"), (F.col("x") + half).alias("rx1"), (F.col("y") + half).alias("ry1"))
    areas = quadtree.rectangle_areas(polys.select(F.col("poly_id").alias("hru"), "geometry"), "hru", c, "cell", bucket)
    return areas.withColumn("weight", F.col("area") / F.sum("area").over(Window.partitionBy("hru"))).select("hru", "cell", "weight")


def assign_zones(pixels: DataFrame, polys: DataFrame, half_x: float, half_y: float, all_touched: bool = True) -> DataFrame:
    """pixel, zone: each pixel (pixel, x, y: its centre) in the zone of each polygon (poly_id) that holds its centre, or
    (all_touched) that has a part of its square. Centres on a west or south side are in, on an east or north side out, so
    polygons side by side share no centre; a side along a square's border doesn't touch it. A pixel of none is left out.
    Pixels lie whole steps apart."""
    return scanline.zones(pixels, polys, "poly_id", half_x, half_y, all_touched).withColumnRenamed("poly_id", "zone")


def crop_window(polys: DataFrame, key: str, half_x: float, half_y: float, buffer: bool = True) -> DataFrame:
    """key and the box (west, south, east, north) to which rasters are cropped for a polygon: its bounds, widened by half
    a pixel's diagonal unless buffer is off."""
    d = math.hypot(half_x, half_y) if buffer else 0.0
    b = _bounds(polys.select(key, "geometry"))
    return b.select(key, (F.col("_x0") - d).alias("west"), (F.col("_y0") - d).alias("south"), (F.col("_x1") + d).alias("east"), (F.col("_y1") + d).alias("north"))


def clip_layer(layer: DataFrame, boxes: DataFrame, bucket: float = 1.0) -> DataFrame:
    """poly_id, box_id, area of each layer polygon inside each box (box_id, rx0, ry0, rx1, ry1)."""
    return quadtree.rectangle_areas(layer, "poly_id", boxes, "box_id", bucket)


def overlaps(layer: DataFrame, basins: DataFrame, bucket: float = 1.0, same: bool = False) -> DataFrame:
    """poly_id, basin_id, area that each layer polygon (poly_id) shares with each basin polygon (basin_id), of any shape,
    holes included; pairs without a common area are left out. same: only pairs of equal ids."""
    return quadtree.polygon_areas(layer, "poly_id", basins, "basin_id", bucket, same)


def intersecting(layer: DataFrame, basins: DataFrame, bucket: float = 1.0) -> DataFrame:
    """Layer polygons kept whole, with each basin polygon (basin_id) that they share area with."""
    return layer.join(overlaps(layer, basins, bucket).select("poly_id", "basin_id"), "poly_id")


def clip_lakes(lakes: DataFrame, parts: DataFrame) -> DataFrame:
    """poly_id, basin_id, area, volume of lakes (poly_id, area, volume) cut to sub-basins, from `overlaps` of their
    outlines in km: areas to two decimals (after nine, so that the last bits of a sum don't decide a tie), volumes in
    proportion to the area."""
    rows = parts.select("poly_id", "basin_id", F.round(F.round("area", 9), 2).alias("_new")).join(lakes.select("poly_id", "area", "volume"), "poly_id")
    return rows.select("poly_id", "basin_id", F.col("_new").alias("area"), (F.col("volume") * F.col("_new") / F.nullif("area", F.lit(0.0))).alias("volume"))


def projected(df: DataFrame) -> DataFrame:
    """The geometry's degrees as km in the equal-area projection."""
    xy = lambda v: albers(v["x"], v["y"])
    return df.withColumn("geometry", F.transform("geometry", lambda v: F.struct(v["ring"].alias("ring"), (xy(v)[0] / 1000).alias("x"), (xy(v)[1] / 1000).alias("y"))))


def overlap_fraction(a: DataFrame, b: DataFrame, bucket: float) -> DataFrame:
    """poly_id, fraction: min(A and B / A, A and B / B) of equal ids, in the plane of the coordinates; 0 without overlap."""
    both = overlaps(a, b.select(F.col("poly_id").alias("basin_id"), "geometry"), bucket, same=True)
    area = lambda df, name: plane_area(df, "poly_id").select("poly_id", F.col("area").alias(name))
    rows = area(a, "_a").join(area(b, "_b"), "poly_id").join(both.select("poly_id", "area"), "poly_id", "left")
    shared = F.coalesce("area", F.lit(0.0))
    return rows.select("poly_id", F.least(shared / F.nullif("_a", F.lit(0.0)), shared / F.nullif("_b", F.lit(0.0))).alias("fraction"))


def snap_to_line(points: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """id, x, y, distance: the nearest point on the line of the point's sub-basin; nulls without a line.

    lines: key, geometry (vertices in order, one ring number per part).
    """
    segs = lines.select(key, F.posexplode("geometry").alias("i", "v")).select(key, "i", "v.*")
    w = Window.partitionBy(key, "ring").orderBy("i")
    segs = segs.withColumns({"x2": F.lead("x").over(w), "y2": F.lead("y").over(w)}).where("x2 is not null").select(key, F.col("x").alias("x1"), F.col("y").alias("y1"), "x2", "y2")
    best = nearest.nearest(points, segs, key)
    return points.select("id").distinct().join(best, "id", "left")


def plane_area(polys: DataFrame, key: str) -> DataFrame:
    """key, area and centroid (cx, cy) in the plane of the coordinates: vertices, lead and a shoelace sum."""
    v = polys.select(key, F.posexplode("geometry").alias("i", "v")).select(key, "i", "v.*")
    w = Window.partitionBy(key, "ring").orderBy("i")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = v.withColumns({"x2": F.coalesce(F.lead("x").over(w), F.first("x").over(whole)), "y2": F.coalesce(F.lead("y").over(w), F.first("y").over(whole))})
    c = F.col("x") * F.col("y2") - F.col("x2") * F.col("y")
    out = v.groupBy(key).agg((F.sum(c) / 2).alias("_a"), F.sum((F.col("x") + F.col("x2")) * c).alias("_cx"), F.sum((F.col("y") + F.col("y2")) * c).alias("_cy"))
    return out.select(key, F.abs("_a").alias("area"), (F.col("_cx") / (6 * F.col("_a"))).alias("cx"), (F.col("_cy") / (6 * F.col("_a"))).alias("cy"))


def poly_area(polys: DataFrame, key: str) -> DataFrame:
    """key, area_km2 and the centroid in the equal-area projection."""
    return plane_area(projected(polys.select(key, "geometry")), key).withColumnRenamed("area", "area_km2")


def line_length(lines: DataFrame, key: str) -> DataFrame:
    """key, length_km in the equal-area projection."""
    v = lines.select(key, F.posexplode("geometry").alias("i", "v")).select(key, "i", "v.*")
    x, y = albers(F.col("x"), F.col("y"))
    v = v.select(key, "ring", "i", (x / 1000).alias("x"), (y / 1000).alias("y"))
    w = Window.partitionBy(key, "ring").orderBy("i")
    dx, dy = F.lead("x").over(w) - F.col("x"), F.lead("y").over(w) - F.col("y")
    return v.withColumn("d", F.sqrt(dx * dx + dy * dy)).groupBy(key).agg(F.coalesce(F.sum("d"), F.lit(0.0)).alias("length_km"))


def drop_tiny(areas: DataFrame, least: float = TINY_KM2) -> DataFrame:
    return areas.where(F.col("area_km2") >= least)


def dissolve(parts: DataFrame, key: str) -> DataFrame:
    """One row per id: the area of its parts and how many there were."""
    return parts.groupBy(key).agg(F.sum("area").alias("area"), F.count("*").alias("n_parts"))


def first_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one id, such as repeated river segments, the first in the given order."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_x")).select(key, "_x.*")
