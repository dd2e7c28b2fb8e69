"""Forcing cubes that lie together: tables bucketed and sorted by cell, so that merging their variables and remapping them
moves no cube.

A table in buckets of cells is partitioned as a join by cell wants it. Cubes are joined on (cell, time): their buckets
decide which rows can meet, and the rest of the key is compared there.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.shared import discard, new_path, written

#: Rows of a cube that a bucket holds, about: a task sorts a bucket of each cube.
ROWS = 1 << 20
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def bucketed(df: DataFrame, buckets: int = 64, cell: str = "cell", name: str = "cube") -> DataFrame:
    """df as a table of the session's catalogue, in buckets by cell, each sorted by it, in the shared folder."""
    table = f"rillflow_{name}_{uuid.uuid4().hex}"
    # Dealt as the buckets are, so that a task writes few files.
    df.repartition(buckets, cell).write.bucketBy(buckets, cell).sortBy(cell).option("path", new_path(df.sparkSession, name)).saveAsTable(table)
    return df.sparkSession.table(table)


@contextlib.contextmanager
def by_bucket(spark: SparkSession) -> Iterator[None]:
    """While a job runs: joins may use a partitioning by a part of their key."""
    old = spark.conf.get(_ALL_KEYS)
    spark.conf.set(_ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(_ALL_KEYS, old)


def joined(cubes: list[DataFrame], keys: list[str]) -> DataFrame:
    """One wide row per key that all cubes have. The join is by sorted buckets: neither side is small."""
    out = cubes[0]
    for cube in cubes[1:]:
        out = out.hint("merge").join(cube, keys)
    return out


def remapped(cubes: list[DataFrame], weights: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """hru, time and each variable's weighted mean over the hru's cells (of those with a value). weights: cell, hru, w, in
    buckets as the cubes are; keys: cell and the time. Only partial sums by (hru, time) are shuffled."""
    rows = joined(cubes, keys).hint("merge").join(weights, "cell")
    mass = lambda v: F.sum(F.when(F.col(v).isNotNull(), F.col("w")))
    return rows.groupBy("hru", *[k for k in keys if k != "cell"]).agg(*[(F.sum(F.col("w") * F.col(v)) / F.nullif(mass(v), F.lit(0.0))).alias(v) for v in variables])


def remap_cubes(cubes: list[DataFrame], weights: DataFrame, keys: list[str], variables: list[str], buckets: int = 64) -> DataFrame:
    """`remapped` of cubes that aren't bucketed yet, as a written table; bucketed ones are used again and again. There are
    at least so many buckets, and more for larger cubes (ROWS of the largest one in each)."""
    spark = weights.sparkSession
    plain = [written(c, "plain-cube") for c in cubes]
    number = min(max(buckets, -(-max(c.count() for c in plain) // ROWS)), 1 << 14)
    own, w = [bucketed(c, number) for c in plain], bucketed(weights, number, name="weights")
    for c in plain:
        discard(c)
    with by_bucket(spark):
        return written(remapped(own, w, keys, variables), "remapped")
