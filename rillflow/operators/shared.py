"""What several operators share: written tables and numbering in a global order."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors see: spark.checkpoint.dir, or in local mode (tests) a new one."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        folder = _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="rillflow-", dir="/tmp"))
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def mounted_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for files that Python opens itself; the folder has to be a mounted one."""
    path = new_path(spark, name)
    scheme, _, rest = path.partition(":") if ":/" in path else ("file", "", path)
    if scheme != "file":
        raise ValueError(f"files need a mounted shared folder, not {path}")
    return "/" + rest.lstrip("/")


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df behind a short lineage: written to the shared folder and read again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a written table that nothing will read again."""
    jvm = df.sparkSession._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def in_order(df: DataFrame, order: list[str], number: str, sums: dict[str, Column]) -> DataFrame:
    """df with the rows' number from 0 in the order of the columns, and each sum over the rows up to and with this one.

    Rows are dealt to ordered ranges and numbered there; only one row per range meets in a window.
    """
    parts = written(df.withColumns({f"_{k}": c for k, c in sums.items()}).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ordered")
    w = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = {number: F.count(F.lit(1)), **{k: F.sum(f"_{k}") for k in sums}}
    totals = parts.groupBy("_part").agg(*[c.alias(f"_of_{k}") for k, c in made.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_part", *[F.coalesce(F.sum(f"_of_{k}").over(before), F.lit(0)).alias(f"_before_{k}") for k in made])
    rows = parts.withColumns({k: c.over(w) for k, c in made.items()}).join(base, "_part")
    rows = rows.withColumns({k: F.col(k) + F.col(f"_before_{k}") - (1 if k == number else 0) for k in made})
    return rows.drop("_part", *[f"_{k}" for k in sums], *[f"_before_{k}" for k in made])
