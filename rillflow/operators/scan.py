"""Scans along a site's time in blocks, with what neighbouring blocks carry over.

A site's rows are dealt to blocks of time, and each block is scanned by itself, so a long or dense site is spread over all
tasks. What a block hands on (its last and next valid value, its open run, its map) is one row; only these rows meet in a
window per site, and the carry is joined back to the block's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Widths of blocks: days of daily series, and microseconds (64 days, whole half hours) of others.
DAYS, MICROS = 1024, 64 * 86_400_000_000

_UP = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def number_of(df: DataFrame, ts: str) -> tuple[Column, int]:
    """A time column as a whole number, and the width of a block in it. Columns that are numbers are microseconds."""
    kind = dict(df.dtypes)[ts]
    if kind == "date":
        return F.unix_date(ts), DAYS
    return (F.unix_micros(F.col(ts).cast("timestamp")) if kind.startswith("timestamp") else F.col(ts)), MICROS


def block_of(t: Column, width: int) -> Column:
    return F.floor(t / F.lit(width)).cast("long")


def neighbours(rows: DataFrame, keys: list[str], t: str, cols: list[str]) -> DataFrame:
    """rows (with a block _b) with, for each column c, _p_c and _n_c: (v, t) of its last valid value up to the row and of
    its next one from the row on."""
    at = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col(t).alias("t"))) for c in cols}
    ends = {f"_{k}e_{c}": f(at[c], F.when(F.col(c).isNotNull(), F.col(t))) for c in cols for k, f in (("p", F.max_by), ("n", F.min_by))}
    over = {"p": Window.partitionBy(*keys).orderBy(F.asc("_b")).rowsBetween(*_BEFORE), "n": Window.partitionBy(*keys).orderBy(F.desc("_b")).rowsBetween(*_BEFORE)}
    one = rows.groupBy(*keys, "_b").agg(*[c.alias(k) for k, c in ends.items()])
    carry = one.select(*keys, "_b", *[F.last(f"_{k}e_{c}", ignorenulls=True).over(w).alias(f"_{k}c_{c}") for c in cols for k, w in over.items()])
    rows = rows.join(carry, [*keys, "_b"])
    inside = {"p": Window.partitionBy(*keys, "_b").orderBy(F.asc(t)).rowsBetween(*_UP), "n": Window.partitionBy(*keys, "_b").orderBy(F.desc(t)).rowsBetween(*_UP)}
    return rows.withColumns({f"_{k}_{c}": F.coalesce(F.last(at[c], ignorenulls=True).over(w), F.col(f"_{k}c_{c}")) for c in cols for k, w in inside.items()}).drop(*[f"_{k}c_{c}" for c in cols for k in "pn"])


def between(c: str, t: str) -> Column:
    """The column, or the value at t on the line between its neighbours."""
    p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
    return F.coalesce(F.col(c), p["v"] + (n["v"] - p["v"]) * (F.col(t) - p["t"]) / (n["t"] - p["t"]))


def runs(rows: DataFrame, keys: list[str], t: str, cond: str) -> DataFrame:
    """rows (with a block _b) with _run, the number of the run of equal conditions that a row lies in, from 1, and _last,
    whether it is its site's last row."""
    w = Window.partitionBy(*keys, "_b").orderBy(t)
    rows = rows.withColumn("_new", F.coalesce((F.col(cond) != F.lag(cond).over(w)).cast("int"), F.lit(0)))
    ends = {"_flips": F.sum("_new"), "_first": F.min_by(cond, t), "_end": F.max_by(cond, t), "_z": F.max(t)}
    by = Window.partitionBy(*keys).orderBy("_b")

    starts = F.coalesce((F.col("_first") != F.lag("_end").over(by)).cast("int"), F.lit(1))
    one = rows.groupBy(*keys, "_b").agg(*[c.alias(k) for k, c in ends.items()])
    one = one.select(*keys, "_b", "_flips", starts.alias("_starts"), F.max("_z").over(Window.partitionBy(*keys)).alias("_z"))
    one = one.withColumn("_base", F.coalesce(F.sum(F.col("_starts") + F.col("_flips")).over(by.rowsBetween(*_BEFORE)), F.lit(0)) + F.col("_starts"))
    rows = rows.join(one.select(*keys, "_b", "_base", "_z"), [*keys, "_b"])
    return rows.withColumns({"_run": F.col("_base") + F.sum("_new").over(w.rowsBetween(*_UP)), "_last": F.col(t) == F.col("_z")}).drop("_new", "_base", "_z")
