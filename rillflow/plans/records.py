"""Queries of gauge files, metadata and attribute tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillflow.functions import legends as L
from rillflow.functions import scalars as S
from rillflow.operators import tables as B
from rillflow.operators import timeseries as T
from rillflow.operators.shared import mounted_path, new_path, written
from rillflow.plans.adapters import FLOW, OBS, RAIN, SITE_SQL, add, events, flow, obs, rain, table
from rillflow.plans.series import EVENT_ORDER, hourly_sql
from rillflow.sources import gauges as G
from rillflow.sources.hydat import read_sqlite, write_sqlite
from rillflow.sources.records import read_records, write_lines

COL = F.col


def rdb_lines(s, d):
    """Each user's events as an RDB file's lines; in every other file the code column comes first."""
    e = table(s, d, "events").withColumn("site", F.lpad(COL("user_id").cast("string"), 8, "0"))
    swapped = COL("user_id") % 2 == 1
    line = F.when(swapped, F.concat_ws("\t", F.lit("USGS"), "site", F.date_format("ts", "yyyy-MM-dd HH:mm"), F.lit("EST"), "event_type", COL("event_id").cast("string"))).otherwise(F.concat_ws("\t", F.lit("USGS"), "site", F.date_format("ts", "yyyy-MM-dd HH:mm"), F.lit("EST"), COL("event_id").cast("string"), "event_type"))
    data = e.select(COL("site").alias("file"), (COL("event_id") + 10).alias("n"), line.alias("line"))
    names = "agency_cd\tsite_no\tdatetime\ttz_cd\t"
    head = e.select("site", swapped.alias("sw")).distinct().select(COL("site").alias("file"), F.posexplode(F.array(F.when(F.col("sw"), "# no parameter").otherwise("# 00060 Discharge"), F.when(F.col("sw"), names + "77_00060_cd\t77_00060").otherwise(names + "77_00060\t77_00060_cd"), F.lit("5s\t15s\t20d\t6s\t14n\t10s"))).alias("n", "line"))
    return data.unionByName(head.withColumn("n", COL("n").cast("long")))


add("s1_read_rdb", lambda s, d: G.read_rdb(rdb_lines(s, d)), "SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS file, lpad(CAST(user_id AS VARCHAR), 8, '0') AS site, strftime(ts, '%Y-%m-%d %H:%M') AS datetime, 'EST' AS tz_cd, CAST(event_id AS VARCHAR) AS obs, event_type AS obs_cd FROM events", "file site datetime tz_cd obs obs_cd")


def _written_lines(s, d):
    """The same lines, as one text file per user."""
    path = mounted_path(s, "rdb")
    write_lines(rdb_lines(s, d).withColumn("file", F.concat(F.lit("file="), "file")), path)
    return path


def _from_files(s, d):
    return read_records(s, f"{_written_lines(s, d)}/*/file=*", bytes_of_range=16384)


def _wsc_files(s, d):
    path = mounted_path(s, "wsc")
    write_lines(wsc_lines(s, d).withColumn("file", F.concat(F.lit("file="), "file")), path)
    return read_records(s, f"{path}/*/file=*", "wsc", bytes_of_range=16384)


add("s1_read_files", _from_files, "SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS site, strftime(ts, '%Y-%m-%d %H:%M') AS datetime, CAST(event_id AS VARCHAR) AS obs, event_type AS obs_cd FROM events", "site datetime obs obs_cd")
add("s2_check_files", lambda s, d: G.check_header(G.lines(s, f"file://{_written_lines(s, d)}/*"), {"variable": "Discharge"}).select(F.regexp_extract("file", "file=([0-9]+)", 1).alias("file"), "missing"), "SELECT DISTINCT lpad(CAST(user_id AS VARCHAR), 8, '0') AS file, 'variable' AS missing FROM events WHERE user_id % 2 = 1", "file missing")
add("s2_check_header", lambda s, d: G.check_header(rdb_lines(s, d), {"variable": "Discharge", "comment": "^#"}), "SELECT DISTINCT lpad(CAST(user_id AS VARCHAR), 8, '0') AS file, 'variable' AS missing FROM events WHERE user_id % 2 = 1", "file missing")


def wsc_lines(s, d):
    e = table(s, d, "events").withColumn("file", (COL("user_id") % 50).cast("string"))
    data = e.select("file", (COL("event_id") + 4).alias("n"), F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd HH:mm"), COL("event_id").cast("string"), (COL("event_id") % 60).cast("string"), "event_type").alias("line"))
    first = e.groupBy("file").agg((F.min("event_id") + 3).alias("last"))
    head = first.select("file", "last", F.posexplode(F.array(F.concat(F.lit("# Station: "), "file"), F.lit("# CSV data starts at line 3"))).alias("i", "line")).select("file", (COL("last") - 1 + COL("i")).cast("long").alias("n"), "line")
    return data.unionByName(head)


add("s3_read_wsc_csv", lambda s, d: G.read_wsc_csv(wsc_lines(s, d))[0], "SELECT CAST(user_id % 50 AS VARCHAR) AS file, strftime(ts, '%Y-%m-%d %H:%M') AS ts, CAST(event_id AS VARCHAR) AS value, CAST(event_id % 60 AS VARCHAR) AS grade, event_type AS approval FROM events", "file ts value grade approval")
add("s3_read_files", _wsc_files, "SELECT strftime(ts, '%Y-%m-%d %H:%M') AS ts, CAST(event_id AS VARCHAR) AS value, CAST(event_id % 60 AS VARCHAR) AS grade, event_type AS approval FROM events", "ts value grade approval")
add("s3_wsc_fields", lambda s, d: G.read_wsc_csv(wsc_lines(s, d))[1], "SELECT DISTINCT CAST(user_id % 50 AS VARCHAR) AS file, 'Station' AS key, CAST(user_id % 50 AS VARCHAR) AS value FROM events", "file key value")


def months(s, d):
    """Wide months: 31 flow and symbol columns per customer group and month."""
    f = flow(s, d).withColumns({"year": F.year("day"), "month": F.month("day"), "n_days": F.dayofmonth(F.last_day("day"))})
    at = lambda i: F.dayofmonth("day") == i
    wide = [F.max(F.when(at(i), COL("q"))).alias(f"flow{i}") for i in range(1, 32)] + [F.max(F.when(at(i) & (COL("q") > 3), "E")).alias(f"symbol{i}") for i in range(1, 32)]
    return f.groupBy(COL("site").alias("station"), "year", "month", "n_days").agg(*wide)


AXIS = f"{FLOW}, mo AS (SELECT DISTINCT site, date_trunc('month', day)::DATE AS m FROM flow), ax AS (SELECT site, unnest(generate_series(m::TIMESTAMP, last_day(m)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM mo)"
add("r1_hydat_to_daily", lambda s, d: B.hydat_to_daily(months(s, d)), f"{AXIS}\n--\nSELECT ax.site AS station, ax.day, CASE WHEN q > 3 THEN 'E' END AS symbol, q AS flow FROM ax LEFT JOIN flow f ON ax.site = f.site AND ax.day = f.day", "station day symbol", "flow")
add("s4_hydat_select", lambda s, d: B.hydat_to_daily(G.hydat_select(months(s, d), months(s, d).where("station % 3 = 0").select("station"))), f"{AXIS}\n--\nSELECT ax.site AS station, ax.day, q AS flow FROM ax LEFT JOIN flow f ON ax.site = f.site AND ax.day = f.day WHERE ax.site % 3 = 0", "station day", "flow")


def _hydat(s, d):
    """The months as SQLite files, of which only the listed stations are read back, of some years."""
    files = written(write_sqlite(months(s, d).repartition(4, "station"), mounted_path(s, "hydat"), "DLY_FLOWS", "station"), "hydat-files").collect()
    rows = read_sqlite(s, ",".join(r.file for r in files), "DLY_FLOWS", "station", parts=3)
    return B.hydat_to_daily(rows.where(COL("station").isin(0, 3, 6, 999) & (COL("year") >= 1997)))


add("s4_read_sqlite", _hydat, f"{AXIS}\n--\nSELECT ax.site AS station, ax.day, CASE WHEN q > 3 THEN 'E' END AS symbol, q AS flow FROM ax LEFT JOIN flow f ON ax.site = f.site AND ax.day = f.day WHERE ax.site IN (0, 3, 6, 999) AND year(ax.day) >= 1997", "station day symbol", "flow")
add("s5_select_vars", lambda s, d: G.select_vars(rain(s, d), ["site", "day"], ["p", "pet", "missing"]), f"{RAIN}\n--\nSELECT site, day, p, pet FROM rain", "site day", "p pet")


def _product(s, d):
    q = T.hourly_quality(events(s, d), ["site"], "ts", "event_type", EVENT_ORDER, {"ice": COL("event_type") == "view"})
    hours = T.resample_hourly(obs(s, d), ["site"], "ts", "value").join(q, ["site", "hour"], "left")
    return B.to_flow_product(hours.withColumns({"quality": F.coalesce("quality", F.lit("n/a")), "ice": F.coalesce("ice", F.lit(0))}), ["site"], {"is_ice_affected": COL("ice")})


_HOURS, _, _RESULT = hourly_sql(False).rpartition("\n--\n")
_PRODUCT = f"""{_HOURS}, hr AS ({_RESULT}),
    e2 AS (SELECT {SITE_SQL} AS site, epoch_us(ts) AS t, event_type AS c FROM events),
    r2 AS (SELECT site, t // 3600000000 AS h, c FROM e2 UNION ALL SELECT site, t // 3600000000 - 1, c FROM e2 WHERE t % 3600000000 = 0),
    q2 AS (SELECT site, make_timestamp(h * 3600000000) AS hour, min_by(c, {{'rk': coalesce(list_position(['view', 'click', 'cart', 'purchase', 'refund'], c), 0), 'c': c}}) AS quality, max(CAST(c = 'view' AS INTEGER)) AS ice FROM r2 GROUP BY site, h)"""
_PRODUCT_ROWS = "SELECT hr.site, hr.hour, hr.hour + INTERVAL 1 HOUR AS bounds_end, coalesce(quality, 'n/a') AS q_obs_data_quality, coalesce(ice, 0) AS q_obs_is_ice_affected, value AS q_obs FROM hr LEFT JOIN q2 ON hr.site = q2.site AND hr.hour = q2.hour"
add("s6_flow_product", _product, f"{_PRODUCT}\n--\n{_PRODUCT_ROWS}", "site hour bounds_end q_obs_data_quality q_obs_is_ice_affected", "q_obs")


def _written_product(s, d):
    """The product of two countries, written by country and read again."""
    path = new_path(s, "product")
    country = F.when(COL("site") % 2 == 0, "CAN").otherwise("USA")
    B.write_product(_product(s, d).withColumn("country", country).withColumn("q_obs", F.when(COL("country") == "USA", S.cubic_metres(COL("q_obs"))).otherwise(COL("q_obs"))), path, ["country"])
    return s.read.parquet(path)


add("s6_write_product", _written_product, f"{_PRODUCT}, pr AS ({_PRODUCT_ROWS})\n--\nSELECT site, hour, CASE WHEN site % 2 = 0 THEN 'CAN' ELSE 'USA' END AS country, q_obs_data_quality, q_obs_is_ice_affected, CASE WHEN site % 2 = 0 THEN q_obs ELSE q_obs * 0.0283168466 END AS q_obs FROM pr", "site hour country q_obs_data_quality q_obs_is_ice_affected", "q_obs")


def pick(names, key: str, size: int):
    """The name at a key's remainder; null beyond the last one."""
    return F.get(F.array(*[F.lit(n) for n in names]), (COL(key) % size).cast("int"))


def said(names) -> str:
    return "[" + ", ".join("NULL" if n is None else "'" + n.replace("'", "''") + "'" for n in names) + "]"


_USA, _CAN = list(L.FLAGS["USA"]), list(L.FLAGS["CAN"])
for _country, _codes in (("USA", _USA), ("CAN", _CAN)):
    _n = len(_codes) + 1
    add(f"s6_flag_meanings_{_country.lower()}", lambda s, d, c=_country, codes=_codes, n=_n: B.flag_meanings(table(s, d, "events").select(F.coalesce(pick(codes, "event_id", n), F.lit("odd")).alias("q_obs_data_quality")), c), f"x AS (SELECT DISTINCT CAST(event_id % {_n} AS INTEGER) AS i FROM events)\n--\nSELECT {said([*_codes, 'odd'])}[i + 1] AS q_obs_data_quality, {said([*L.FLAGS[_country].values(), None])}[i + 1] AS meaning FROM x", "q_obs_data_quality meaning")


def attributes(s, d):
    n = COL("n_nationkey")
    o = table(s, d, "customer").join(table(s, d, "nation"), COL("c_nationkey") == n)
    per = o.groupBy((n % 5).cast("string").alias("basin"), F.concat_ws("_", F.lit("a"), F.lpad((COL("c_custkey") % 14).cast("string"), 2, "0")).alias("attribute")).agg(F.avg("c_acctbal").alias("value"))
    return per.withColumns({"category": F.lit("Climate"), "unit": F.lit("mm"), "source": F.lit("x")})


ATTR = "att AS (SELECT CAST(c_nationkey % 5 AS VARCHAR) AS basin, 'a_' || lpad(CAST(c_custkey % 14 AS VARCHAR), 2, '0') AS attribute, avg(c_acctbal) AS value FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"
PIVOT = ", ".join(f"max(value) FILTER (basin = '{i}') AS b{i}" for i in range(5))
WIDE = [f"b{i}" for i in range(5)]


def wide(s, d):
    w = B.write_attributes(attributes(s, d), [str(i) for i in range(5)])
    return w.withColumnsRenamed({str(i): f"b{i}" for i in range(5)})


add("s7_write_attributes", wide, f"{ATTR}\n--\nSELECT 'Climate' AS category, attribute, 'mm' AS unit, 'x' AS source, {PIVOT} FROM att GROUP BY attribute", "category attribute unit source", " ".join(WIDE))
def _written_wide(s, d):
    path = new_path(s, "attributes")
    w = wide(s, d)
    B.write_wide(w, path)
    return s.read.option("header", True).schema(w.schema).csv(path)


add("s7_write_wide", _written_wide, f"{ATTR}\n--\nSELECT 'Climate' AS category, attribute, 'mm' AS unit, 'x' AS source, {PIVOT} FROM att GROUP BY attribute", "category attribute unit source", " ".join(WIDE))
add("r2_unpivot_attributes", lambda s, d: B.unpivot_attributes(wide(s, d).withColumnRenamed("attribute", "name"), ["name"], WIDE), f"{ATTR}\n--\nSELECT attribute AS name, 'b' || basin AS attribute, value FROM att", "name attribute", "value")
add("r3_correct_units", lambda s, d: B.correct_units(attributes(s, d), {"a_00": "K"}, {"a": "W"}), f"{ATTR}\n--\nSELECT basin, attribute, CASE attribute WHEN 'a_00' THEN 'K' WHEN 'a_13' THEN 'mm' ELSE 'W' END AS unit, value FROM att", "basin attribute unit", "value")
add("s8_merge_periods", lambda s, d: B.merge_periods(B.stack_tables(flow(s, d).where("day < '1997-01-01'"), flow(s, d).where("day >= '1997-01-01'")), "site", "day"), f"{FLOW}\n--\nSELECT * FROM flow", "site day", "q")


def stations(s, d):
    c = COL("c_custkey")
    return table(s, d, "customer").select(F.when(c % 2 == 0, "CAN").otherwise("USA").alias("country"), c.cast("string").alias("station"), "c_acctbal", c.alias("id"))


def unusable(s, d):
    return stations(s, d).where("c_acctbal < 0").select("country", "station", F.when(COL("id") % 3 == 0, "dv").otherwise("iv").alias("missing"))


add("j1_drop_unusable", lambda s, d: B.drop_unusable(stations(s, d), unusable(s, d), "iv"), "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'CAN' ELSE 'USA' END AS country, CAST(c_custkey AS VARCHAR) AS station FROM customer WHERE NOT (c_acctbal < 0 AND c_custkey % 3 <> 0)", "country station")
add("j9_subset_ids", lambda s, d: B.subset_ids(table(s, d, "orders").select("o_orderkey", "o_custkey"), table(s, d, "customer").where("c_acctbal > 5000").select(COL("c_custkey").alias("o_custkey")), "o_custkey"), "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)", "o_orderkey o_custkey")


def _subbasins(s, d):
    c = table(s, d, "customer").select((COL("c_custkey") % 30).alias("basin"), COL("c_custkey").alias("comid"))
    return B.select_subbasins(c, c.where("comid % 4 = 1 and basin % 3 <> 0"), c.groupBy("basin").agg(F.max("comid").alias("comid")))


add("j9_select_subbasins", _subbasins, "c AS (SELECT c_custkey % 30 AS basin, c_custkey AS comid FROM customer), r AS (SELECT * FROM c WHERE comid % 4 = 1 AND basin % 3 <> 0)\n--\nSELECT * FROM r UNION ALL SELECT basin, max(comid) FROM c WHERE basin NOT IN (SELECT basin FROM r) GROUP BY basin", "basin comid")


def _period(s, d):
    o = table(s, d, "orders").groupBy((COL("o_custkey") % 2).cast("string").alias("country"), COL("o_custkey").cast("string").alias("station")).agg(*[f(F.when(COL("o_orderkey") % 2 == i, COL("o_orderdate"))).cast("string").alias(f"{k}_{n}") for i, k in enumerate(("iv", "dv")) for n, f in (("start", F.min), ("end", F.max))])
    bad = table(s, d, "customer").where("c_acctbal < 0").select((COL("c_custkey") % 2).cast("string").alias("country"), COL("c_custkey").cast("string").alias("station"), F.when(COL("c_custkey") % 3 == 0, "dv").otherwise("iv").alias("missing"))
    return B.record_period(o, bad, ["country", "station"]).withColumnsRenamed({"start": "first_day", "end": "final_day"})


add("p11_record_period", _period, """o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 2 = 0 THEN 'iv' ELSE 'dv' END AS k FROM orders), b AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'dv' ELSE 'iv' END AS k FROM customer WHERE c_acctbal < 0)
--
SELECT CAST(o_custkey % 2 AS VARCHAR) AS country, CAST(o_custkey AS VARCHAR) AS station, min(day) AS first_day, max(day) AS final_day FROM o WHERE NOT EXISTS (SELECT 1 FROM b WHERE c_custkey = o_custkey AND b.k = o.k) GROUP BY o_custkey""", "country station first_day final_day")


def coded(s, d):
    e = COL("event_id")
    a = F.when(e % 5 == 0, "Checked").when(e % 5 == 1, "Undefined").when(e % 5 == 2, "Ready for Approval").otherwise("Approved")
    return table(s, d, "events").select("event_id", (e % 7 * 10).cast("int").alias("grade"), a.alias("approval"))


NORM = "c AS (SELECT event_id, CAST(event_id % 7 * 10 AS INTEGER) AS g, CASE event_id % 5 WHEN 0 THEN 'Checked' WHEN 1 THEN 'Undefined' WHEN 2 THEN 'Ready for Approval' ELSE 'Approved' END AS a FROM events), n AS (SELECT *, CASE WHEN g IN (10, 20, 30, 40, 50) THEN g ELSE 0 END AS grade, CASE WHEN a IN ('Checked', 'Ready for Approval') THEN 'Reviewed' WHEN a = 'Undefined' THEN 'nan' ELSE a END AS approval FROM c)"
add("p12_normalise_codes", lambda s, d: B.normalise_wsc_codes(coded(s, d)), f"{NORM}\n--\nSELECT event_id, grade, approval FROM n", "event_id grade approval")
add("p12_count_replaced", lambda s, d: B.count_replaced(coded(s, d), B.normalise_wsc_codes(coded(s, d)), ["event_id"], "approval"), f"{NORM}\n--\nSELECT a AS old, approval AS new, count(*) AS n FROM n WHERE a <> approval GROUP BY ALL", "old new n")
add("p13_filter_dates", lambda s, d: B.filter_dates(rain(s, d), "day", last_months=24, month=[1, 7], dom=[1, 15]), f"{RAIN}, m AS (SELECT max(day) - INTERVAL 24 MONTH AS m FROM rain)\n--\nSELECT site, day, p FROM rain, m WHERE day >= m AND month(day) IN (1, 7) AND day(day) IN (1, 15)", "site day", "p")
add("p14_subset_category", lambda s, d: B.subset_category(table(s, d, "customer").withColumns({"area": F.abs("c_acctbal") * 2, "n_sub": COL("c_custkey") % 10}), "c_custkey", "area", "n_sub"), "SELECT c_custkey, CASE WHEN c_custkey % 10 = 1 THEN 'headwater' WHEN abs(c_acctbal) * 2 <= 1000 THEN 'meso' WHEN abs(c_acctbal) * 2 <= 10000 THEN 'macro' ELSE 'excluded' END AS category FROM customer", "c_custkey category")


def _coords(s, d):
    c = COL("c_custkey")
    m = table(s, d, "customer").select("c_custkey", *[F.when(c % (i + 2) == 0, c * (i + 1) / 7).otherwise(-999.0).cast("double").alias(f"{n}_{x}") for i, n in enumerate(("manual", "mapped", "outlet")) for x in ("lat", "lon")], (c / 3).alias("station_lat"), (c / 3).alias("station_lon"))
    return B.best_coords(m)


add("p15_best_coords", _coords, "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'manual' WHEN c_custkey % 3 = 0 THEN 'mapped' WHEN c_custkey % 4 = 0 THEN 'outlet' ELSE 'station' END AS origin, CASE WHEN c_custkey % 2 = 0 THEN c_custkey / 7 WHEN c_custkey % 3 = 0 THEN c_custkey * 2 / 7 WHEN c_custkey % 4 = 0 THEN c_custkey * 3 / 7 ELSE c_custkey / 3 END AS lat, CASE WHEN c_custkey % 2 = 0 THEN c_custkey / 7 WHEN c_custkey % 3 = 0 THEN c_custkey * 2 / 7 WHEN c_custkey % 4 = 0 THEN c_custkey * 3 / 7 ELSE c_custkey / 3 END AS lon FROM customer", "c_custkey origin", "lat lon")
add("p16_harmonise_stations", lambda s, d: B.harmonise_stations(table(s, d, "supplier").select(COL("s_suppkey").alias("station"), COL("s_name").alias("name"), F.abs("s_acctbal").alias("area_km2")), table(s, d, "customer").select(COL("c_custkey").alias("station"), COL("c_name").alias("name"), (F.abs("c_acctbal") * 1000).alias("area_m2"))), "SELECT 'CAN' AS country, CAST(s_suppkey AS VARCHAR) AS station, s_name AS name, abs(s_acctbal) AS area_km2 FROM supplier UNION ALL SELECT 'USA', lpad(CAST(c_custkey AS VARCHAR), 8, '0'), c_name, abs(c_acctbal) / 1000 FROM customer", "country station name", "area_km2")
add("u1_stack_tables", lambda s, d: B.stack_tables(flow(s, d), rain(s, d).select("site", "day", "p")), f"{FLOW}, {RAIN}\n--\nSELECT site, day, q, NULL AS p FROM flow UNION ALL SELECT site, day, NULL, p FROM rain", "site day", "q p")
add("u2_merge_blocks", lambda s, d: B.merge_blocks([attributes(s, d), attributes(s, d).withColumn("category", F.lit("Soil"))], "basin"), f"{ATTR}\n--\nSELECT basin, attribute, unnest(['Climate', 'Soil']) AS category, value FROM att", "basin attribute category", "value")
add("u3_upsert_series", lambda s, d: B.upsert_series(flow(s, d), flow(s, d).where("site % 2 = 0 and day > '1999-01-01'").withColumn("q", COL("q") * 2), "site"), f"{FLOW}\n--\nSELECT site, day, CASE WHEN site % 2 = 0 THEN q * 2 ELSE q END AS q FROM flow WHERE site % 2 = 1 OR day > DATE '1999-01-01'", "site day", "q")


def _replaced(s, d):
    path = new_path(s, "series")
    B.write_series(flow(s, d), path, "site", 16)
    B.replace_series(path, flow(s, d).where("site % 3 = 0 and day > '1999-01-01'").withColumn("q", COL("q") * 2), "site", 16)
    return s.read.parquet(path)


add("u3_replace_series", _replaced, f"{FLOW}\n--\nSELECT site, day, CASE WHEN site % 3 = 0 THEN q * 2 ELSE q END AS q FROM flow WHERE site % 3 <> 0 OR day > DATE '1999-01-01'", "site day", "q")
add("u4_common_times", lambda s, d: B.common_times(flow(s, d), rain(s, d), ["site", "day"]), f"{FLOW}, {RAIN}\n--\nSELECT site, day FROM flow INTERSECT SELECT site, day FROM rain", "site day")
add("u4_id_differences", lambda s, d: B.id_differences(flow(s, d), rain(s, d), ["site", "day"]), f"{FLOW}, {RAIN}\n--\nSELECT site, day, 'left' AS side FROM (SELECT site, day FROM flow EXCEPT SELECT site, day FROM rain) UNION ALL SELECT site, day, 'right' FROM (SELECT site, day FROM rain EXCEPT SELECT site, day FROM flow)", "site day side")


def availability(s, d):
    o = table(s, d, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("z"), F.count_distinct(F.to_date("o_orderdate")).alias("n"))
    return B.availability(o.withColumn("lost", F.datediff("z", "a") + 1 - COL("n")), "o_custkey", "a", "z", "lost")


AVAIL = "av AS (SELECT o_custkey, date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) + 1 AS dur, count(DISTINCT CAST(o_orderdate AS DATE)) AS n FROM orders GROUP BY o_custkey)"
add("a27_availability", availability, f"{AVAIL}\n--\nSELECT o_custkey, CAST(dur AS INTEGER) AS duration, (dur - n) / dur AS missing_share, n / 365.25 AS net_years, cume_dist() OVER (ORDER BY n / 365.25) AS cdf FROM av", "o_custkey duration", "missing_share net_years cdf")
add("a27_year_histogram", lambda s, d: B.year_histogram(availability(s, d).withColumn("net_years", COL("net_years") * 365.25)), f"{AVAIL}\n--\nSELECT CAST(floor(n / 5) * 5 AS BIGINT) AS bin, count(*) AS n FROM av GROUP BY ALL", "bin n")
add("a30_nested_ids", lambda s, d: B.nested_ids(table(s, d, "lineitem").select(COL("l_suppkey").alias("basin"), COL("l_partkey").alias("comid"), (COL("l_extendedprice") / COL("l_quantity")).alias("area")), "basin", "comid", "area", 50.0), "SELECT l_partkey AS comid, count(DISTINCT l_suppkey) AS n_basins, max(l_extendedprice / l_quantity) - min(l_extendedprice / l_quantity) > 50 AS areas_differ FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1", "comid n_basins areas_differ")


def _updated(s, d):
    meta = table(s, d, "customer").select(COL("c_custkey").alias("site"), F.lit("1900-01-01").cast("date").alias("first"), F.lit("1900-12-31").cast("date").alias("last"), F.lit(-1).cast("long").alias("n_missing"))
    series = table(s, d, "orders").select(COL("o_custkey").alias("site"), F.to_date("o_orderdate").alias("day"), F.when(COL("o_totalprice") > 1e5, COL("o_totalprice")).alias("q"))
    return B.update_meta(meta, series, "site", "day", "q").withColumnsRenamed({"first": "first_day", "last": "last_day"})


add("a35_update_meta", _updated, "p AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z, count(*) FILTER (NOT o_totalprice > 1e5) AS n FROM orders GROUP BY o_custkey)\n--\nSELECT c_custkey AS site, coalesce(a, DATE '1900-01-01') AS first_day, coalesce(z, DATE '1900-12-31') AS last_day, coalesce(n, -1) AS n_missing FROM customer LEFT JOIN p ON c_custkey = o_custkey", "site first_day last_day n_missing")


def sizes(s, d):
    return table(s, d, "customer").select("c_custkey", (F.abs("c_acctbal") + COL("c_custkey") / 1e6).alias("area"), (COL("c_custkey") * 7919 % 1000).alias("size"))


add("w9_size_tradeoff", lambda s, d: B.size_tradeoff(sizes(s, d), "c_custkey", "area", "size"), """x AS (SELECT c_custkey, abs(c_acctbal) + c_custkey / 1e6 AS area, c_custkey * 7919 % 1000 AS size FROM customer), a AS (SELECT c_custkey, area, sum(size) OVER (ORDER BY area, c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS cumulative FROM x),
    b AS (SELECT *, lead(cumulative) OVER w - 2 * cumulative + lag(cumulative) OVER w AS second FROM a WINDOW w AS (ORDER BY area, c_custkey)), c AS (SELECT *, sign(second) * lag(sign(second)) OVER (ORDER BY area, c_custkey) < 0 AS ch FROM b)
--
SELECT c_custkey, cumulative, second, area, max(CASE WHEN ch THEN area END) OVER () AS cut FROM c""", "c_custkey cumulative second", "area cut")
add("w9_area_thresholds", lambda s, d: B.area_thresholds(sizes(s, d), [100, 1000, 5000], "area", "size"), "x AS (SELECT abs(c_acctbal) + c_custkey / 1e6 AS area, c_custkey * 7919 % 1000 AS size FROM customer)\n--\nSELECT t AS threshold, count(*) AS n, sum(size)::BIGINT AS total FROM x, (SELECT unnest([100, 1000, 5000]) AS t) WHERE area <= t GROUP BY t", "n total", "threshold")
add("t2_top_season", lambda s, d: B.season_counts_top(rain(s, d).where("p > 2"), ["site"], S.season(F.month("day"))), f"{RAIN}, c AS (SELECT site, CASE WHEN month(day) IN (12, 1, 2) THEN 'djf' WHEN month(day) IN (3, 4, 5) THEN 'mam' WHEN month(day) IN (6, 7, 8) THEN 'jja' ELSE 'son' END AS l, count(*) AS n FROM rain WHERE p > 2 GROUP BY ALL)\n--\nSELECT site, min_by(l, {{'n': -n, 'l': l}}) AS label, max(n) AS n FROM c GROUP BY site", "site label n")
add("t3_sorted_series", lambda s, d: T.dst_to_lst(obs(s, d).withColumn("tz_cd", F.when(F.hour("ts") < 12, "EDT").otherwise("EST")), ["site"], "ts", "tz_cd").transform(B.merge_periods, "site", "ts"), f"{OBS}\n--\nSELECT site, CASE WHEN hour(ts) < 12 THEN ts - INTERVAL 1 HOUR ELSE ts END AS ts, value FROM obs", "site ts", "value")
_TZ, _PROV = list(L.TIME_ZONES), list(L.PROVINCES)


def _codes(s, d):
    """Codes by event, each set with one that isn't known."""
    e = table(s, d, "events")
    return e.select("event_id", S.mapped(F.coalesce(pick(_PROV, "event_id", 14), F.lit("ZZ")), L.PROVINCES).alias("province"), S.mapped(F.coalesce(pick(_TZ, "user_id", 12), F.lit("XST")), L.TIME_ZONES).alias("utc"), S.mapped(F.coalesce(pick(list(S.UTC_OFFSETS), "event_id", 9), F.lit("UTC")), S.UTC_OFFSETS).alias("standard"))


add("m11_codes", _codes, f"SELECT event_id, {said([*L.PROVINCES.values(), None])}[CAST(event_id % 14 AS INTEGER) + 1] AS province, {said([*L.TIME_ZONES.values(), None])}[CAST(user_id % 12 AS INTEGER) + 1] AS utc, {said([*S.UTC_OFFSETS.values(), None])}[CAST(event_id % 9 AS INTEGER) + 1] AS standard FROM events", "event_id province utc standard")


def _names(s, d):
    path = F.concat(F.lit("/data/CAN_"), F.lpad(COL("o_custkey").cast("string"), 7, "0"), F.lit("_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".nc"))
    basin, period = S.from_file_name(path)
    return table(s, d, "orders").select("o_orderkey", basin.alias("basin"), period.alias("period"))


add("m12_file_names", _names, "SELECT o_orderkey, 'CAN_' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS basin, strftime(o_orderdate, '%Y-%m') AS period FROM orders", "o_orderkey basin period")


def _user_function(s, d):
    """A user's own aggregate, given as any column expression."""
    return T.resample(flow(s, d), ["site"], "day", "year", {"range": F.max("q") - F.min("q"), "direction": S.circular_mean(F.dayofyear("day").cast("double"), 366.0)})


add("f2_user_aggregates", _user_function, f"{FLOW}, x AS (SELECT site, date_trunc('year', day)::TIMESTAMP AS period, max(q) - min(q) AS range, avg(sin(2 * pi() * dayofyear(day) / 366)) AS sn, avg(cos(2 * pi() * dayofyear(day) / 366)) AS cs FROM flow GROUP BY ALL)\n--\nSELECT site, period, range, (atan2(sn, cs) * 366 / (2 * pi()) + 366) % 366 AS direction FROM x", "site period", "range direction", 5)
