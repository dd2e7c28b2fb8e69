"""Nearest segments by branch and bound over a quadtree of cells.

The segments of a key lie in cells of a grid that is finer the more of them there are. A point starts with the whole grid
and goes down two levels at a time: of the cells that hold segments it keeps those that may hold a nearer one than the
farthest that a kept cell's segments can be. In the end it meets the segments of a few cells, not those of its whole key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.operators.shared import discard, written

#: Segments of a cell, about, and levels at most.
FEW, DEPTH = 8, 16


def squared(x: Column, y: Column) -> Column:
    return x * x + y * y


def grids(segments: DataFrame, key: str) -> DataFrame:
    """key, x0, y0, side and depth of the grid of each key: 4^depth cells for FEW segments each."""
    per = segments.groupBy(key).agg(F.least(F.min("x1"), F.min("x2")).alias("gx"), F.least(F.min("y1"), F.min("y2")).alias("gy"), F.greatest(F.max("x1"), F.max("x2")).alias("zx"), F.greatest(F.max("y1"), F.max("y2")).alias("zy"), F.count("*").alias("n"))
    side = F.greatest(F.col("zx") - F.col("gx"), F.col("zy") - F.col("gy"))
    depth = F.when(side > 0, F.least(F.greatest(F.ceil(F.log2(F.col("n") / FEW) / 2), F.lit(0)) * 2, F.lit(DEPTH))).otherwise(0).cast("int")
    return per.select(key, "gx", "gy", side.alias("side"), depth.alias("depth"))


def cells_of(segments: DataFrame, grid: DataFrame, key: str) -> DataFrame:
    """key, depth, ix, iy and the segment, for each cell that the segment may cross: it is cut into pieces no longer than
    a cell, and each piece is in the cells that its box touches."""
    rows = segments.join(grid, key)
    cell = F.col("side") / F.pow(F.lit(2.0), F.col("depth"))
    length = F.sqrt(squared(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))
    pieces = F.greatest(F.ceil(length / F.nullif(F.col("_cell"), F.lit(0.0))), F.lit(1))
    rows = rows.withColumn("_cell", cell).withColumn("_k", F.coalesce(pieces, F.lit(1)).cast("int")).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    last = (F.pow(F.lit(2.0), F.col("depth")) - 1).cast("long")

    def span(a: str, b: str, origin: str) -> Column:
        at = [F.col(a) + (F.col(b) - F.col(a)) * (F.col("_i") + i) / F.col("_k") for i in (0, 1)]
        place = [F.least(F.greatest(F.coalesce(F.floor((x - F.col(origin)) / F.nullif(F.col("_cell"), F.lit(0.0))), F.lit(0)), F.lit(0)), last) for x in at]
        return F.explode(F.sequence(F.least(*place), F.greatest(*place)))

    rows = rows.withColumn("ix", span("x1", "x2", "gx")).withColumn("iy", span("y1", "y2", "gy"))
    return rows.select(key, "depth", "ix", "iy", "x1", "y1", "x2", "y2").distinct()


def candidates(points: DataFrame, cells: DataFrame, grid: DataFrame, key: str) -> DataFrame:
    """id, x, y, key, ix, iy: the cells that may hold a point's nearest segment. A cell's segments may lie up to a cell
    beside it (they are there by their pieces' boxes), which the farther bound allows for."""
    deepest = cells.agg(F.max("depth")).first()[0] or 0
    now = points.join(grid, key).select("id", "x", "y", key, "gx", "gy", "side", "depth", F.lit(0).cast("long").alias("ix"), F.lit(0).cast("long").alias("iy"))
    for level in range(2, deepest + 1, 2):
        up = lambda c, n: F.floor(F.col(c) / F.pow(F.lit(2.0), n))
        here = cells.where(F.col("depth") >= level).select(key, up("ix", F.col("depth") - level).alias("cx"), up("iy", F.col("depth") - level).alias("cy")).distinct()
        here = here.withColumns({"ix": F.floor(F.col("cx") / 4), "iy": F.floor(F.col("cy") / 4)})
        going = now.where(F.col("depth") >= level).join(here, [key, "ix", "iy"])
        cell = F.col("side") / F.lit(2.0**level)
        west, south = F.col("gx") + F.col("cx") * cell, F.col("gy") + F.col("cy") * cell
        off = lambda p, low: F.greatest(low - F.col(p), F.col(p) - (low + cell), F.lit(0.0))
        far = lambda p, low: F.greatest(F.abs(F.col(p) - low), F.abs(F.col(p) - (low + cell)))
        going = going.withColumns({"_low": F.sqrt(squared(off("x", west), off("y", south))), "_high": F.sqrt(squared(far("x", west), far("y", south))) + 2 * cell})
        going = written(going.drop("ix", "iy").withColumnsRenamed({"cx": "ix", "cy": "iy"}), "near")
        bound = going.groupBy("id").agg(F.min("_high").alias("_bound"))
        kept = going.join(bound, "id").where(F.col("_low") * (1 - 1e-9) <= F.col("_bound")).drop("_low", "_high", "_bound")
        old, now = now, written(now.where(F.col("depth") < level).unionByName(kept), "candidates")
        discard(going)
        if level > 2:
            discard(old)
    return now


def nearest(points: DataFrame, segments: DataFrame, key: str) -> DataFrame:
    """id, x, y, distance of the nearest place on the segments (x1, y1, x2, y2) of each point's key, for points (id, x, y)
    whose key has some. Ties go to the smallest x, then y."""
    grid = written(grids(segments, key), "grids")
    cells = written(cells_of(segments, grid, key), "cells")
    on = candidates(points.select("id", "x", "y", key), cells, grid, key).join(cells, [key, "depth", "ix", "iy"])
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = ((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.coalesce(F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    px, py = F.col("x1") + t * dx, F.col("y1") + t * dy
    d = F.sqrt(squared(px - F.col("x"), py - F.col("y")))
    on = on.select("id", px.alias("px"), py.alias("py"), d.alias("d"))
    best = on.groupBy("id").agg(F.min(F.struct("d", "px", "py")).alias("b"))
    return best.select("id", F.col("b.px").alias("x"), F.col("b.py").alias("y"), F.col("b.d").alias("distance"))
