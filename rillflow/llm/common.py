"""What several operators share: staged tables in the shared folder, mounted paths and distributed running totals."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.operators.shared import discard, new_path
from rillflow.operators.shared import written as staged

__all__ = ["BLANKS", "LOWER", "UPPER", "WORDS", "bucket_bits", "discard", "hash_bucket", "mounted", "new_path", "running_total", "staged"]

#: ASCII white space, as every contract on words splits on it.
BLANKS = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def mounted(uri: str) -> str:
    """A shared folder's path for open() and memory maps; only mounted folders have one."""
    scheme, _, rest = uri.partition(":") if re.match(r"[a-z0-9]+:/", uri) else ("file", "", uri)
    if scheme != "file":
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {uri}")
    return "/" + rest.lstrip("/")


def bucket_bits(n: int) -> int:
    """Bits of a hash that deal n rows to about sqrt(n) buckets of about sqrt(n) rows."""
    return max(1, (max(n, 1).bit_length() + 1) // 2)


def hash_bucket(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits)


def running_total(df: DataFrame, groups: list[str], bucket: str, order: list[str], value: Column, out: str) -> DataFrame:
    """Adds the sum of value over the rows before this one in its group, ordered by (bucket, order).

    No task holds a group: rows are summed within (group, bucket), and only one sum per bucket meets in a group's
    window, so a group of any share of the rows is dealt over all its buckets.
    """
    before = (Window.unboundedPreceding, -1)
    keyed = df.withColumn("_v", value.cast("long"))
    inner = keyed.withColumn("_in", F.coalesce(F.sum("_v").over(Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(*before)), F.lit(0)))
    sums = keyed.groupBy(*groups, bucket).agg(F.sum("_v").alias("_s"))
    base = sums.withColumn("_base", F.coalesce(F.sum("_s").over(Window.partitionBy(*groups).orderBy(bucket).rowsBetween(*before)), F.lit(0))).drop("_s")
    return inner.join(base, [*groups, bucket]).withColumn(out, F.col("_in") + F.col("_base")).drop("_in", "_base", "_v")
