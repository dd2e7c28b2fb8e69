"""Readers of national gauge formats: RDB text, self-describing CSV, and the wide monthly table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file and line of text files, for what doesn't need the lines' order (check_header); see `records` for the rest."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r$", "").alias("line"))


def read_rdb(rows: DataFrame, site_col: str = "site_no", param: str = "00060") -> DataFrame:
    """Lines (file, n, line) of tab-separated RDB files to file, site, datetime, tz_cd, obs, obs_cd, all text.

    Lines with # are comments; the first other line names the columns, the next one gives formats and is dropped. The
    value column is the one whose name ends in _<param> (or _<param>_00003); its code column ends in _cd as well.
    Files may have their columns in different places: each file's header is joined to its rows.
    """
    rows = rows.where(~F.col("line").startswith("#") & (F.trim("line") != ""))
    heads = rows.groupBy("file").agg(F.min_by("line", "n").alias("head"), F.min("n").alias("first")).select("file", "first", F.split("head", "\t").alias("names"))
    at = lambda pattern: F.array_position(F.transform("names", lambda c: c.rlike(pattern)), True).cast("int")
    value = rf"_{param}(_00003)?"
    cols = heads.select("file", "first", at(f"^{site_col}$").alias("s"), at("^datetime$").alias("d"), at("^tz_cd$").alias("z"), at(f"{value}$").alias("v"), at(f"{value}_cd$").alias("c"))
    cells = F.split("line", "\t")
    cell = lambda k: F.when(F.col(k) > 0, F.nullif(F.get(cells, F.col(k) - 1), F.lit("")))
    out = rows.join(cols, "file").where(F.col("n") > F.col("first")).select("file", cell("s").alias("site"), cell("d").alias("datetime"), cell("z").alias("tz_cd"), cell("v").alias("obs"), cell("c").alias("obs_cd"))
    return out.where(~F.col("site").rlike(r"^\d+[sdn]$"))


def check_header(rows: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(file, missing) of files whose comment lines lack an expected pattern (name: regular expression)."""
    head = F.when(F.col("line").startswith("#"), F.col("line"))
    per = rows.groupBy("file").agg(*[F.max(F.coalesce(head.rlike(p), F.lit(False))).alias(k) for k, p in expected.items()])
    lost = F.array_compact(F.array(*[F.when(~F.col(k), F.lit(k)) for k in expected]))
    return per.select("file", F.explode(lost).alias("missing"))


def read_wsc_csv(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines (file, n from 1, line) of CSV files whose header describes itself to (rows, fields).

    '# CSV data starts at line N' names the first data line, '# key: value' lines are fields. Rows: file, ts, value,
    grade, approval, as text. Fields: file, key, value. Line numbers may start anywhere in a file.
    """
    start = F.regexp_extract("line", r"(?i)data starts at line (\d+)", 1).try_cast("int")
    per = rows.groupBy("file").agg(F.max(start).alias("start"), F.min("n").alias("first"))
    fields = rows.where("line like '#%:%'").select("file", F.trim(F.regexp_extract("line", "^#\\s*([^:]+):", 1)).alias("key"), F.trim(F.regexp_extract("line", "^#[^:]*:(.*)$", 1)).alias("value"))
    cells = F.split("line", ",")
    data = rows.join(per, "file").where(F.col("n") - F.col("first") + 1 >= F.col("start")).where("line <> ''")
    return data.select("file", *[F.nullif(F.trim(F.get(cells, i)), F.lit("")).alias(c) for i, c in enumerate(("ts", "value", "grade", "approval"))]), fields


def hydat_select(table: DataFrame, ids: DataFrame, key: str = "station") -> DataFrame:
    """Rows of the monthly table of the listed stations."""
    return table.join(ids.select(key).distinct(), key, "left_semi")


def select_vars(df: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """The keys and the listed variables that the cube has; column pruning reaches the scan."""
    return df.select(*keys, *[c for c in keep if c in df.columns])
