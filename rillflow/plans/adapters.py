"""The driver's tables as the library's tables, each as a DataFrame and as the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SITE_SQL = "user_id % (SELECT count(*) // 50000 + 4 FROM events)"
OBS = f"obs AS (SELECT {SITE_SQL} AS site, ts, avg(value) AS value, min(event_type) AS code FROM events GROUP BY ALL)"
FLOW = "flow AS (SELECT o_custkey % (SELECT count(*) // 30000 + 8 FROM orders) AS site, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) / 99991 AS q FROM orders GROUP BY ALL)"
RAIN = "rain AS (SELECT l_suppkey % (SELECT count(*) // 120000 + 8 FROM lineitem) AS site, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) / 100 AS p, avg(l_extendedprice) / 137 AS t, avg(l_extendedprice) / 9973 AS pet FROM lineitem GROUP BY ALL)"
PIXELS = "pix AS (SELECT vec_id AS row, CAST(i AS INTEGER) AS col, CAST(embedding[i + 1] AS DOUBLE) AS value, label AS zone FROM embeddings, unnest(range(0, len(embedding))) AS u(i))"
NET = "net AS (SELECT c_nationkey * 0 AS basin, c_custkey AS comid, c_custkey // 2 AS next_down, abs(c_acctbal) / 97 AS length, 1.0 + c_custkey % 7 AS unitarea, CAST(c_custkey % 5 AS INTEGER) AS ord FROM customer WHERE c_custkey > 0)"


def sites(s, d, name: str, rows: int, least: int) -> int:
    """The number of sites that a table is dealt to: it grows with the table, so that a site's series stays dense."""
    return table(s, d, name).count() // rows + least


def events(s, d) -> DataFrame:
    return table(s, d, "events").withColumn("site", F.col("user_id") % sites(s, d, "events", 50000, 4))


def obs(s, d) -> DataFrame:
    return events(s, d).groupBy("site", "ts").agg(F.avg("value").alias("value"), F.min("event_type").alias("code"))


def flow(s, d) -> DataFrame:
    site = F.col("o_custkey") % sites(s, d, "orders", 30000, 8)
    return table(s, d, "orders").groupBy(site.alias("site"), F.to_date("o_orderdate").alias("day")).agg((F.sum("o_totalprice") / 99991).alias("q"))


def rain(s, d) -> DataFrame:
    site = F.col("l_suppkey") % sites(s, d, "lineitem", 120000, 8)
    return table(s, d, "lineitem").groupBy(site.alias("site"), F.to_date("l_shipdate").alias("day")).agg((F.sum("l_quantity") / 100).alias("p"), (F.avg("l_extendedprice") / 137).alias("t"), (F.avg("l_extendedprice") / 9973).alias("pet"))


def pixels(s, d) -> DataFrame:
    return table(s, d, "embeddings").select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "v"), F.col("label").alias("zone")).select("row", "col", F.col("v").cast("double").alias("value"), "zone")


def net(s, d) -> DataFrame:
    c = F.col("c_custkey")
    return table(s, d, "customer").where(c > 0).select((F.col("c_nationkey") * 0).alias("basin"), c.alias("comid"), F.floor(c / 2).alias("next_down"), (F.abs("c_acctbal") / 97).alias("length"), (1.0 + c % 7).cast("double").alias("unitarea"), (c % 5).cast("int").alias("ord"))


def add(name: str, run, sql: str | None, keys: str = "", doubles: str = "", digits: int = 6) -> None:
    """Registers a query. Its doubles are rounded on both sides (adding 0.0 makes a negative zero positive); times are
    returned without a zone."""
    ks, ds = keys.split(), doubles.split()

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        kinds = dict(df.dtypes)
        cols = [F.col(k).cast("timestamp_ntz").alias(k) if kinds[k] == "timestamp" else F.col(k) for k in ks]
        return df.select(*cols, *[(F.round(F.col(c).cast("double"), digits) + F.lit(0.0)).alias(c) for c in ds])

    QUERIES[name] = query
    if sql:
        cols = ", ".join([*ks, *(f"round(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in ds)])
        body = sql.strip()
        head, _, last = body.rpartition("\n--\n")
        ORACLE_SQL[name] = f"WITH {head}\nSELECT {cols} FROM ({last}) AS result" if head else f"SELECT {cols} FROM ({last}) AS result"
