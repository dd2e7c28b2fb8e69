"""Polygons as runs of raster cells, by scan lines.

The sides of a polygon are an edge table; each row of the raster takes the sides that reach it. What a polygon covers is
then a few runs (row, first column, last column) per row instead of a row per pixel and polygon, and pixels meet runs by
row and block of columns.

A raster is given by the centre of its first cell and the spacing: cell (row, col) has its centre at
(x0 + col * dx, y0 + row * dy), rows and columns from 0. Border rule of centres: on a west or south side a centre is in,
on an east or north side out, so of polygons side by side one holds each centre. Border rule of touched cells: a side
touches a cell if it crosses its inner part; a side along a cell's border doesn't.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.operators.quadtree import meeting, rings_of

#: Rows of the raster that are scanned at a time, and columns of the blocks in which pixels meet runs.
BAND, BLOCK = 4096, 256


class Raster(NamedTuple):
    x0: float
    y0: float
    dx: float
    dy: float
    rows: int
    cols: int


def cells_between(a: np.ndarray, b: np.ndarray, at, n: int, closed_low: bool) -> tuple[np.ndarray, np.ndarray]:
    """First and last index i in 0..n-1 with a <= at(i) < b (closed_low) or a < at(i) < b; first > last if none. The places
    at(i) themselves are compared, so rounding of the division doesn't matter."""
    step = at(1) - at(0)
    first = np.clip(np.floor((a - at(0)) / step), 0, n).astype(np.int64)
    last = np.clip(np.ceil((b - at(0)) / step), -1, n - 1).astype(np.int64)
    for _ in range(2):
        low = (at(first) < a) if closed_low else (at(first) <= a)
        first = np.where(low & (first < n), first + 1, first)
    for _ in range(2):
        last = np.where((last >= 0) & (at(last) >= b), last - 1, last)
    return first, last


def reached(low: np.ndarray, high: np.ndarray, rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(side, row) of every row from first to last, inside the band."""
    first, last = np.maximum(first, rows[0]), np.minimum(last, rows[-1])
    n = np.maximum(last - first + 1, 0)
    side = np.repeat(np.arange(len(n)), n)
    return side, np.arange(len(side)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def spans(sides: np.ndarray, raster: Raster, rows: np.ndarray, touched: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of one polygon in some neighbouring rows; sides: x1, y1, x2, y2."""
    x1, y1, x2, y2 = sides.T
    low, high = np.minimum(y1, y2), np.maximum(y1, y2)
    centre_y, centre_x = (lambda r: raster.y0 + r * raster.dy), (lambda c: raster.x0 + c * raster.dx)
    # Where the line through a row's centres meets the sides, in order: in from an odd one to the next.
    side, row = reached(low, high, rows, *cells_between(low, high, centre_y, raster.rows, True))
    x = meeting(centre_y(row), x1[side], y1[side], x2[side], y2[side], np.ones(len(side), bool))
    order = np.lexsort((x, row))
    row, x = row[order], x[order]
    row, a, b = row[::2], x[::2], x[1::2]
    if not touched:
        first, last = cells_between(a, b, centre_x, raster.cols, True)
        return row[first <= last], first[first <= last], last[first <= last]
    # Cells whose inner part meets these spans, or what a side covers in x between the row's borders.
    borders = lambda r: raster.y0 + (r - 0.5) * raster.dy
    top = lambda r: raster.y0 + (r + 0.5) * raster.dy
    first = np.clip(np.floor((low - borders(0)) / raster.dy), 0, raster.rows).astype(np.int64)
    last = np.clip(np.floor((high - borders(0)) / raster.dy), -1, raster.rows - 1).astype(np.int64)
    side, own = reached(low, high, rows, first, last)
    ya, yb = np.maximum(low[side], borders(own)), np.minimum(high[side], top(own))
    flat = low[side] == high[side]
    ok = (ya < yb) | (flat & (borders(own) < low[side]) & (low[side] < top(own)))
    side, own, ya, yb, flat = side[ok], own[ok], ya[ok], yb[ok], flat[ok]
    xa, xb = (meeting(y, x1[side], y1[side], x2[side], y2[side], ~flat) for y in (ya, yb))
    xa, xb = np.where(flat, x1[side], xa), np.where(flat, x2[side], xb)
    row, a, b = np.concatenate([row, own]), np.concatenate([a, np.minimum(xa, xb)]), np.concatenate([b, np.maximum(xa, xb)])
    west, east = (lambda c: raster.x0 + (c - 0.5) * raster.dx), (lambda c: raster.x0 + (c + 0.5) * raster.dx)
    first, last = cells_between(a, np.full(len(a), np.inf), east, raster.cols, False)[0], cells_between(np.full(len(a), -np.inf), b, west, raster.cols, True)[1]
    return row[first <= last], first[first <= last], last[first <= last]


def merged(row: np.ndarray, first: np.ndarray, last: np.ndarray, cols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same cells as runs that neither meet nor follow each other directly."""
    a, z = row * (cols + 1) + first, row * (cols + 1) + last
    order = np.argsort(a, kind="stable")
    a, z = a[order], np.maximum.accumulate(z[order])
    heads = np.flatnonzero(np.concatenate([[True], a[1:] > z[:-1] + 1]))
    ends = z[np.concatenate([heads[1:] - 1, [len(z) - 1]])]
    row, first = np.divmod(a[heads], cols + 1)
    return row, first, ends - row * (cols + 1)


def runs(polys: DataFrame, key: str, raster: Raster, touched: bool = False) -> DataFrame:
    """key, row, first, last: the runs of cells whose centre each polygon holds, or (touched) of those that its sides touch
    besides. Cells outside the raster are left out; null and empty polygons have none."""
    kind = polys.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rings in enumerate(rings_of(batch.column("geometry"))):
                if not rings:
                    continue
                sides = np.concatenate([np.concatenate([r, np.roll(r, -1, 0)], 1) for r in rings])
                low, high = (f(sides[:, 1], sides[:, 3]) for f in (np.minimum, np.maximum))
                y = np.array([low.min(), high.max()])
                start, end = np.clip(np.floor((y - raster.y0) / raster.dy).astype(np.int64) + [-1, 2], 0, raster.rows)
                for r in range(start, end, BAND):
                    rows = np.arange(r, min(r + BAND, end))
                    own = (high >= raster.y0 + (rows[0] - 1) * raster.dy) & (low <= raster.y0 + (rows[-1] + 1) * raster.dy)
                    row, first, last = spans(sides[own], raster, rows, touched) if own.any() else (rows[:0],) * 3
                    if len(row):
                        row, first, last = merged(row, first, last, raster.cols)
                        yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(np.full(len(row), i))), *map(pa.array, (row, first, last))], names=[key, "row", "first", "last"])

    return polys.select(key, "geometry").mapInArrow(scan, f"`{key}` {kind}, row long, first long, last long")


def raster_of(pixels: DataFrame, half_x: float, half_y: float) -> Raster:
    """The raster whose cells the pixels (x, y: their centres) are; whole steps apart."""
    r = pixels.agg(F.min("x").alias("x"), F.min("y").alias("y"), F.max("x").alias("x1"), F.max("y").alias("y1")).first()
    if r.x is None:
        return Raster(0.0, 0.0, 2 * half_x, 2 * half_y, 0, 0)
    dx, dy = 2 * half_x, 2 * half_y
    return Raster(float(r.x), float(r.y), dx, dy, round((r.y1 - r.y) / dy) + 1, round((r.x1 - r.x) / dx) + 1)


def zones(pixels: DataFrame, polys: DataFrame, key: str, half_x: float, half_y: float, touched: bool) -> DataFrame:
    """pixel and the key of each polygon that has its cell, by the runs of the raster that the pixels form."""
    raster = raster_of(pixels, half_x, half_y)
    place = lambda c, start, step: F.round((F.col(c) - F.lit(start)) / F.lit(step)).cast("long")
    at = pixels.select("pixel", place("y", raster.y0, raster.dy).alias("row"), place("x", raster.x0, raster.dx).alias("col"))
    at = at.withColumn("block", F.floor(F.col("col") / BLOCK))
    dealt = runs(polys, key, raster, touched).withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor(F.col("last") / BLOCK))))
    return at.join(dealt, ["row", "block"]).where("col between first and last").select("pixel", key)
