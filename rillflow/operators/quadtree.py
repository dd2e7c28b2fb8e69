"""Polygons as leaves of a linear quadtree, and what their leaves share with points, rectangles and each other.

A polygon is halved in x and y inside one batch function, until a part is a whole square, is empty, or is no larger than
a bucket and has at most VERTICES corners. A leaf's key is its square: the level (squares of level k have a side of
bucket / 2^k) and its place (ix, iy) on that level. Two squares share area only if one is the other's or lies under it, so
leaves meet points, rectangles and other leaves by equal keys on the levels that occur; nothing is paired that lies in
different squares, and no row ever carries a whole ring beside the leaves cut from it.

Polygons and points that are copies of each other are cut and met once, as one shape or place; only what was found is then
spread over the copies, as a stream.

Of whole squares only bounds are needed, which are column expressions. Other leaves carry their sides (ARRAY<DOUBLE> each
of x1, y1, x2, y2), and numpy takes all pairs of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.operators.shared import written

#: Corners of a leaf at most, halvings below a bucket at most, and pairs of sides that numpy holds at a time.
VERTICES, DEPTH, PAIRS = 32, 24, 1 << 20
#: Rows that a task makes of pairs of shapes, about.
DEALT = 1 << 22
#: Parts with less than this share of their square (or of the smaller polygon's leaf) are rounding, not area.
NOTHING = 1e-12
_SIDES = ("x1", "y1", "x2", "y2")


def keep_side(ring: np.ndarray, axis: int, bound: float, above: bool) -> np.ndarray:
    """The part of a ring on one side of a line along an axis. A side is cut from its lower end, so that neighbours
    that share it are cut at the same point."""
    d = ring[:, axis] - bound if above else bound - ring[:, axis]
    inside = d >= 0
    if inside.all():
        return ring
    if not inside.any():
        return ring[:0]
    q, e = np.roll(ring, 1, 0), np.roll(d, 1)
    cross = inside != (e >= 0)
    swap = (q[:, axis] > ring[:, axis])[:, None]
    low, high = np.where(swap, ring, q), np.where(swap, q, ring)
    span = high[:, axis] - low[:, axis]
    t = np.divide(bound - low[:, axis], span, out=np.zeros_like(span), where=cross)
    met = low + t[:, None] * (high - low)
    met[:, axis] = bound
    return np.stack([met, ring], 1).reshape(-1, 2)[np.stack([cross, inside], 1).ravel()]


def halves(rings: list[np.ndarray], axis: int, bound: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The rings' parts below and above a line."""
    sides = [[p for r in rings if len(p := keep_side(r, axis, bound, above)) > 2] for above in (False, True)]
    return sides[0], sides[1]


def signed_area(rings: list[np.ndarray]) -> float:
    """Positive if counter-clockwise; holes run the other way. Taken from a corner, so far-off coordinates lose nothing."""
    total = 0.0
    for r in rings:
        x, y = (r - r[0]).T
        total += float(x @ np.roll(y, -1) - np.roll(x, -1) @ y) / 2
    return total


def rings_of(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The rings of each row of a column ARRAY<STRUCT<ring, x, y>>; a null has none."""
    offsets, values = column.offsets.to_numpy(), column.values
    ring = values.field("ring").to_numpy(zero_copy_only=False)
    xy = np.stack([values.field(c).to_numpy(zero_copy_only=False) for c in "xy"], 1).astype(float)
    for i, known in enumerate(column.is_valid().to_pylist()):
        own, part = ring[offsets[i] : offsets[i + 1]], xy[offsets[i] : offsets[i + 1]]
        if not known or not len(own):
            yield []
            continue
        order = np.argsort(own, kind="stable") if (own[1:] < own[:-1]).any() else slice(None)
        own, part = own[order], part[order]
        yield [r for r in np.split(part, np.flatnonzero(own[1:] != own[:-1]) + 1) if len(r) > 2]


def cut(rings: list[np.ndarray], bucket: float, most: int = VERTICES) -> Iterator[tuple[int, int, int, float, list[np.ndarray] | None]]:
    """(level, ix, iy, area, rings) of each leaf; whole squares have no rings."""
    if not rings:
        return
    corners = np.concatenate(rings)
    low, high = corners.min(0), corners.max(0)
    if not np.isfinite(corners).all() or (high <= low).any():
        return
    level = -int(np.ceil(np.log2((high - low).max() / bucket)))  # a square at least as wide as the polygon
    size = bucket * 2.0**-level
    a, z = np.floor(low / size).astype(int), np.floor(high / size).astype(int)
    todo = [(level, ix, iy, rings) for ix in range(a[0], z[0] + 1) for iy in range(a[1], z[1] + 1)]
    for k, (lv, ix, iy, part) in enumerate(todo):
        for axis, at in ((0, ix), (1, iy)):
            part = halves(halves(part, axis, at * size)[1], axis, (at + 1) * size)[0]
        todo[k] = lv, ix, iy, part
    while todo:
        level, ix, iy, part = todo.pop()
        if not part:
            continue
        size = bucket * 2.0**-level
        n = sum(map(len, part))
        if level >= DEPTH or (level >= 0 and n <= most) or n <= 8:
            area = abs(signed_area(part))
            if area <= NOTHING * size * size:
                continue
            xy = np.concatenate(part)
            on_x, on_y = (xy[:, 0] == ix * size) | (xy[:, 0] == (ix + 1) * size), (xy[:, 1] == iy * size) | (xy[:, 1] == (iy + 1) * size)
            if (on_x & on_y).all() and abs(area - size * size) <= NOTHING * size * size:
                yield level, ix, iy, area, None
                continue
            if level >= 0:
                yield level, ix, iy, area, part
                continue
        west, east = halves(part, 0, (ix + 0.5) * size)
        for i, side in ((2 * ix, west), (2 * ix + 1, east)):
            south, north = halves(side, 1, (iy + 0.5) * size)
            todo += [(level + 1, i, 2 * iy, south), (level + 1, i, 2 * iy + 1, north)]


def shapes(polys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(_shape, geometry) of the different geometries, and the polygons as (key, _shape). Both are written tables."""
    different = polys.select("geometry").where("geometry is not null").distinct()
    kinds = written(different.withColumn("_shape", F.monotonically_increasing_id()), "shapes")
    return kinds, written(polys.select(key, "geometry").join(kinds, "geometry").select(key, "_shape"), "members")


def spread(pairs: DataFrame, left: DataFrame, left_on: list[str], right: DataFrame, right_on: list[str]) -> DataFrame:
    """Each pair with each row of left and of right that it stands for. Rows are made as they are read, never held; where
    there are many, the left side is dealt so that each task makes about DEALT of them."""
    count = lambda df, on, name: df.groupBy(*on).agg(F.count("*").cast("double").alias(name))
    sizes = pairs.join(count(left, left_on, "_n"), left_on).join(count(right, right_on, "_m"), right_on)
    made = sizes.agg(F.coalesce(F.sum(F.col("_n") * F.col("_m")), F.lit(0.0))).first()[0]
    rows = pairs.join(left, left_on)
    if made > DEALT:
        rows = rows.repartition(int(min(made // DEALT + 1, 1 << 14)))
    return rows.join(right, right_on)


def once(df: DataFrame, keys: list[str], members: list[tuple[DataFrame, str]]) -> DataFrame:
    """df's areas added up by its keys, unless no polygon has several rows; then they are sums already."""
    if all(m.groupBy(k).count().where("count > 1").isEmpty() for m, k in members):
        return df.select(*keys, "area")
    return df.groupBy(*keys).agg(F.sum("area").alias("area"))


def leaves(polys: DataFrame, key: str, bucket: float) -> DataFrame:
    """key, level, ix, iy, whole, area, the bounds (px0, py0, px1, py1) and the sides of each leaf, as a written table.
    Polygons without area, and null or empty ones, have no leaves."""
    kind = polys.schema[key].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sides, waiting = [], [], 0
            for i, rings in enumerate(rings_of(batch.column("geometry"))):
                for level, ix, iy, area, part in cut(rings, bucket):
                    size = bucket * 2.0**-level
                    if part is None:
                        bounds, own = (ix * size, iy * size, (ix + 1) * size, (iy + 1) * size), np.zeros((0, 4))
                    else:
                        own = np.concatenate([np.concatenate([r, np.roll(r, -1, 0)], 1) for r in part])
                        own = own[(own[:, :2] != own[:, 2:]).any(1)]
                        bounds = (*own[:, :2].min(0).tolist(), *own[:, :2].max(0).tolist())
                    rows.append((i, level, ix, iy, part is None, area, *bounds))
                    sides.append(own)
                    waiting += len(own) + 1
                    if waiting > PAIRS // 8:
                        yield packed(batch, rows, sides)
                        rows, sides, waiting = [], [], 0
            if rows:
                yield packed(batch, rows, sides)

    def packed(batch: pa.RecordBatch, rows: list[tuple], sides: list[np.ndarray]) -> pa.RecordBatch:
        at, level, ix, iy, whole, area, *bounds = zip(*rows, strict=True)
        laid, ends = np.concatenate(sides), np.concatenate([[0], np.cumsum([len(s) for s in sides])]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(laid[:, c].copy())) for c in range(4)]
        fixed = [pa.array(level, pa.int32()), pa.array(ix, pa.int64()), pa.array(iy, pa.int64()), pa.array(whole), pa.array(area, pa.float64()), *(pa.array(b, pa.float64()) for b in bounds)]
        return pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(at)), *fixed, *lists], names=names)

    names = [key, "level", "ix", "iy", "whole", "area", "px0", "py0", "px1", "py1", *_SIDES]
    kinds = ["int", "long", "long", "boolean", *["double"] * 5, *["array<double>"] * 4]
    schema = ", ".join(f"`{c}` {k}" for c, k in zip(names, [kind, *kinds], strict=True))
    return written(polys.select(key, "geometry").mapInArrow(apply, schema), "leaves")


def levels(df: DataFrame) -> list[int]:
    """The levels that occur: a few dozen at most, whatever the polygons."""
    return sorted(r.level for r in df.select("level").distinct().collect())


def side_of(level: Column, bucket: float) -> Column:
    return F.lit(bucket) * F.pow(F.lit(2.0), -level)


def listed(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def points_at(points: DataFrame, bucket: float, on: list[int]) -> DataFrame:
    """The points with the square (level, ix, iy) that holds each, on every level given."""
    rows = points.withColumn("level", F.explode(listed(on)))
    size = side_of(F.col("level"), bucket)
    return rows.withColumns({"ix": F.floor(F.col("x") / size), "iy": F.floor(F.col("y") / size)})


def in_polygons(points: DataFrame, polys: DataFrame, key: str, bucket: float) -> DataFrame:
    """The points' columns with the key of each polygon that holds the point; x and y are its coordinates."""
    kinds, members = shapes(polys, key)
    own, rows = leaves(kinds, "_shape", bucket), written(points, "points")
    met = points_at(rows.select("x", "y").distinct(), bucket, levels(own)).join(own, ["level", "ix", "iy"])
    columns = ["x", "y", "_shape"]
    near = met.where("not whole and x between px0 and px1 and y between py0 and py1").select(*columns, *_SIDES)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(c) for c in _SIDES]
            x, y = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in "xy")
            keep = inside(x, y, np.diff(lists[0].offsets.to_numpy()), *[c.flatten().to_numpy() for c in lists])
            yield batch.select(columns).filter(pa.array(keep))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in near.schema if f.name not in _SIDES)
    pairs = written(met.where("whole").select(*columns).unionByName(near.mapInArrow(test, schema)), "points-in-shapes")
    return spread(pairs, rows, ["x", "y"], members, ["_shape"]).select(*points.columns, key)


def inside(x: np.ndarray, y: np.ndarray, n: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> np.ndarray:
    """Which points lie in the polygons whose n sides each are given in order, by the number of sides to their east. On a
    west or south side is in, on an east or north side is out, so of polygons side by side one holds each point."""
    of = np.repeat(np.arange(len(x)), n)
    return np.bincount(of[crossed(x[of], y[of], x1, y1, x2, y2)], minlength=len(x)) % 2 == 1


def crossed(x: np.ndarray, y: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> np.ndarray:
    """Whether a ray to the east meets the side; sides count from their lower end, up to but without the upper one."""
    cross = (y1 > y) != (y2 > y)
    return cross & (x < meeting(y, x1, y1, x2, y2, cross))


def meeting(y: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The x of sides at y, from the lower end whichever way a side runs."""
    swap = y1 > y2
    xl, yl, xh, yh = np.where(swap, x2, x1), np.where(swap, y2, y1), np.where(swap, x1, x2), np.where(swap, y1, y2)
    return xl + np.divide((xh - xl) * (y - yl), yh - yl, out=np.zeros_like(xl), where=where)


def rectangles_at(rects: DataFrame, bucket: float, on: list[int] | None = None) -> DataFrame:
    """The rectangles (rx0, ry0, rx1, ry1) with each square that they reach: on their own level (rlevel: the finest whose
    squares are as wide as they are), or on each given level that is no finer than that."""
    wide = F.greatest(F.col("rx1") - F.col("rx0"), F.col("ry1") - F.col("ry0"))
    fits = F.when(wide > 0, F.floor(F.log2(F.lit(bucket) / wide))).otherwise(DEPTH)
    rows = rects.withColumn("rlevel", F.greatest(F.least(fits, F.lit(DEPTH)), F.lit(-60)).cast("int"))
    rows = rows.withColumn("level", F.col("rlevel") if on is None else F.explode(F.filter(listed(on), lambda v: v <= F.col("rlevel"))))
    size = side_of(F.col("level"), bucket)
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))
    return rows.withColumn("ix", span("rx0", "rx1")).withColumn("iy", span("ry0", "ry1"))


def above(own: DataFrame, on: list[int], strictly: bool) -> DataFrame:
    """The leaves with the square over each (level, ix, iy; their own level is leaf) on every given level that is coarser,
    or as coarse."""
    rows = own.withColumnRenamed("level", "leaf")
    rows = rows.withColumn("level", F.explode(F.filter(listed(on), lambda v: v < F.col("leaf") if strictly else v <= F.col("leaf"))))
    by = F.col("leaf") - F.col("level")
    return rows.withColumns({c: F.floor(F.col(c) / F.pow(F.lit(2.0), by)) for c in ("ix", "iy")})


def pair_areas(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys and the area that the sides of each row share with its other sides (o_x1, ...)."""
    theirs = [f"o_{c}" for c in _SIDES]

    def areas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = []
            for names in (_SIDES, theirs):
                lists = [batch.column(c) for c in names]
                both.append((lists[0].offsets.to_numpy() - lists[0].offsets[0].as_py(), [c.flatten().to_numpy() for c in lists]))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(shared_areas(*both[0], *both[1]))], names=[*keys, "area"])

    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, *_SIDES, *theirs).mapInArrow(areas, f"{schema}, area double")


def shared_areas(ends_a: np.ndarray, sides_a: list[np.ndarray], ends_b: np.ndarray, sides_b: list[np.ndarray]) -> np.ndarray:
    """The area that polygon i of a shares with polygon i of b, of any shape, holes included.

    A polygon is the signed sum of what lies under its sides, so the shared area is the signed sum, over all pairs of
    sides, of what lies under both: the integral of the lower one of two lines.
    """
    n, m = np.diff(ends_a), np.diff(ends_b)
    out, first, sizes = np.zeros(len(n)), 0, n * m
    upto = np.cumsum(sizes)
    while first < len(n):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PAIRS, "right")))
        of = np.repeat(np.arange(first, last), sizes[first:last])
        k = np.arange(len(of)) - np.repeat(upto[first:last] - sizes[first:last] - (upto[first - 1] if first else 0), sizes[first:last])
        i, j = ends_a[of] + k // m[of], ends_b[of] + k % m[of]
        ax1, ay1, ax2, ay2 = (s[i] for s in sides_a)
        bx1, by1, bx2, by2 = (s[j] for s in sides_b)
        lo = np.maximum(np.minimum(ax1, ax2), np.minimum(bx1, bx2))
        width = np.minimum(np.maximum(ax1, ax2), np.maximum(bx1, bx2)) - lo
        at = np.flatnonzero(width > 0)
        of, lo, width, base = of[at], lo[at], width[at], sides_a[1][ends_a[of[at]]]
        ends = []
        for x1, y1, x2, y2 in ((ax1[at], ay1[at], ax2[at], ay2[at]), (bx1[at], by1[at], bx2[at], by2[at])):
            slope = (y2 - y1) / (x2 - x1)
            start = y1 - base + (lo - x1) * slope
            ends.append((start, start + width * slope, np.sign(x1 - x2)))
        (a0, a1, sa), (b0, b1, sb) = ends
        d0, d1 = a0 - b0, a1 - b1
        lower = (np.minimum(a0, b0) + np.minimum(a1, b1)) / 2
        cross = d0 * d1 < 0
        t = np.divide(d0, d0 - d1, out=np.zeros_like(d0), where=cross)
        middle = a0 + t * (a1 - a0)
        lower = np.where(cross, (np.minimum(a0, b0) + middle) / 2 * t + (middle + np.minimum(a1, b1)) / 2 * (1 - t), lower)
        out[first:last] = np.abs(np.bincount(of - first, sa * sb * lower * width, minlength=last - first))
        first = last
    return out


def square_sides(x0: Column, y0: Column, x1: Column, y1: Column) -> dict[str, Column]:
    """The two sides of a rectangle that are not upright, as other sides."""
    return {"o_x1": F.array(x0, x1), "o_y1": F.array(y0, y1), "o_x2": F.array(x1, x0), "o_y2": F.array(y0, y1)}


def _overlap(*bounds: tuple[str, str, str, str]) -> Column:
    """The area that rectangles, given by the names of their bounds, have in common; 0 if none."""
    c = lambda pick, i: pick(*[F.col(b[i]) for b in bounds])
    return F.greatest(c(F.least, 2) - c(F.greatest, 0), F.lit(0.0)) * F.greatest(c(F.least, 3) - c(F.greatest, 1), F.lit(0.0))


def rectangle_areas(polys: DataFrame, key: str, rects: DataFrame, rect: str, bucket: float) -> DataFrame:
    """key, rect, area of each polygon inside each rectangle (rect, rx0, ry0, rx1, ry1) that it shares area with."""
    kinds, members = shapes(polys, key)
    own = leaves(kinds, "_shape", bucket)
    r = rects.select(rect, "rx0", "ry0", "rx1", "ry1")
    fine = rectangles_at(r, bucket)
    r_levels = levels(fine)
    near = "px0 < rx1 and px1 > rx0 and py0 < ry1 and py1 > ry0"
    columns = ["_shape", rect, "whole", "area", "px0", "py0", "px1", "py1", "rx0", "ry0", "rx1", "ry1", *_SIDES]
    square = ["level", "ix", "iy"]
    met = own.join(rectangles_at(r, bucket, levels(own)), square).where(near).select(*columns)
    met = met.unionByName(above(own, r_levels, strictly=True).join(fine, square).where(near).select(*columns))
    part, box = ("px0", "py0", "px1", "py1"), ("rx0", "ry0", "rx1", "ry1")
    covered = (F.col("rx0") <= F.col("px0")) & (F.col("px1") <= F.col("rx1")) & (F.col("ry0") <= F.col("py0")) & (F.col("py1") <= F.col("ry1"))
    simple = met.where(F.col("whole") | covered).select("_shape", rect, F.when(covered, F.col("area")).otherwise(_overlap(part, box)).alias("area"))
    rest = met.where(~(F.col("whole") | covered)).withColumns(square_sides(*[F.col(c) for c in box]))
    areas = written(_summed(simple.unionByName(pair_areas(rest, ["_shape", rect])), ["_shape", rect], bucket), "shape-areas")
    return once(areas.join(members, "_shape"), [key, rect], [(members, key)])


def polygon_areas(a: DataFrame, key_a: str, b: DataFrame, key_b: str, bucket: float, same: bool = False) -> DataFrame:
    """key_a, key_b, area of each two polygons that share area. same: only pairs of equal keys."""
    if same:
        both = a.select(key_a, F.col("geometry").alias("_a")).join(b.select(key_b, F.col("geometry").alias("_b")), F.col(key_a) == F.col(key_b))
        kinds = written(both.select("_a", "_b").distinct().withColumn("_shape", F.monotonically_increasing_id()), "shapes")
        members = written(both.join(kinds, ["_a", "_b"]).select(key_a, key_b, "_shape"), "members")
        sides = [kinds.select(F.col("_shape").alias(k), F.col(g).alias("geometry")) for k, g in (("_shape", "_a"), ("_other", "_b"))]
        areas = _shape_areas(sides[0], "_shape", sides[1], "_other", bucket, same=True)
        return once(areas.join(members, "_shape"), [key_a, key_b], [(members, key_a)])
    (kinds_a, own), (kinds_b, theirs) = shapes(a, key_a), shapes(b, key_b)
    kinds_b, other = (df.withColumnRenamed("_shape", "_other") for df in (kinds_b, theirs))
    areas = written(_shape_areas(kinds_a, "_shape", kinds_b, "_other", bucket), "shape-areas")
    return once(spread(areas, own, ["_shape"], other, ["_other"]), [key_a, key_b], [(own, key_a), (other, key_b)])


def _shape_areas(a: DataFrame, key_a: str, b: DataFrame, key_b: str, bucket: float, same: bool = False) -> DataFrame:
    """The same, whatever the polygons."""
    own = leaves(a, key_a, bucket)
    named = {c: f"o_{c}" for c in ("whole", "area", "px0", "py0", "px1", "py1", *_SIDES)}
    other = leaves(b, key_b, bucket).withColumnsRenamed(named)
    square = ["level", "ix", "iy"]
    near = "px0 < o_px1 and px1 > o_px0 and py0 < o_py1 and py1 > o_py0" + (f" and `{key_a}` = `{key_b}`" if same else "")
    columns = [key_a, key_b, "coarser", "whole", "area", *[f"o_{c}" for c in ("whole", "area")], *_SIDES, *[f"o_{c}" for c in _SIDES], "px0", "py0", "px1", "py1", "o_px0", "o_py0", "o_px1", "o_py1"]
    # Either the first one's square lies over the second one's (or is the same), or it lies under it.
    met = own.join(above(other, levels(own), strictly=False), square).where(near).withColumn("coarser", F.lit(True)).select(*columns)
    met = met.unionByName(above(own, levels(other), strictly=True).join(other, square).where(near).withColumn("coarser", F.lit(False)).select(*columns))
    first, second = F.col("whole") & F.col("coarser"), F.col("o_whole") & (~F.col("coarser") | F.col("whole"))
    simple = met.where(first | second).select(key_a, key_b, F.when(first, F.col("o_area")).otherwise(F.col("area")).alias("area"))
    rest = met.where(~(first | second))
    # A whole square that lies in the other one's leaf has no sides of its own yet.
    mine = {k.removeprefix("o_"): F.when(F.col("whole"), v).otherwise(F.col(k.removeprefix("o_"))) for k, v in square_sides(*[F.col(c) for c in ("px0", "py0", "px1", "py1")]).items()}
    theirs = {k: F.when(F.col("o_whole"), v).otherwise(F.col(k)) for k, v in square_sides(*[F.col(f"o_{c}") for c in ("px0", "py0", "px1", "py1")]).items()}
    return _summed(simple.unionByName(pair_areas(rest.withColumns(mine | theirs), [key_a, key_b])), [key_a, key_b], bucket)


def _summed(parts: DataFrame, keys: list[str], bucket: float) -> DataFrame:
    """Parts added up; a pair whose parts are all rounding (NOTHING of a bucket) shares no area."""
    return parts.groupBy(*keys).agg(F.sum("area").alias("area")).where(F.col("area") > NOTHING * bucket * bucket)
