"""Queries of time series, signatures and climate. In the SQL, a line of two dashes parts common tables and result."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillflow.functions import scalars as S
from rillflow.operators import climate as C
from rillflow.operators import signatures as G
from rillflow.operators import timeseries as T
from rillflow.plans.adapters import FLOW, OBS, RAIN, SITE_SQL, add, events, flow, obs, rain, table

SITE = ["site"]
EVENT_ORDER = ("view", "click", "cart", "purchase", "refund")


def by_doy(c: str) -> str:
    """A day of year as an angle, in SQL."""
    return f"2 * pi() * ({c}) / 366"


def hourly_sql(center: bool) -> str:
    shift, edge = ("1800000000", "1800000000") if center else ("0", "0")
    return f"""{OBS},
    o AS (SELECT site, epoch_us(ts) AS t, value AS v FROM obs),
    span AS (SELECT site, min(t) AS f, max(t) AS l, ceil(min(t) / 1800000000)::BIGINT * 1800000000 AS a, floor(max(t) / 1800000000)::BIGINT * 1800000000 AS z FROM o GROUP BY site),
    marks AS (SELECT site, t FROM span, unnest(range(a, z + 1, 1800000000)) AS u(t)),
    grid AS (SELECT site, t, max(v) AS v, count(v0) AS ob FROM (SELECT site, t, v, 1 AS v0 FROM o UNION ALL SELECT site, t, NULL, NULL FROM marks) GROUP BY site, t),
    f AS (SELECT *, last_value(CASE WHEN ob > 0 AND v >= 0 THEN v END IGNORE NULLS) OVER (PARTITION BY site ORDER BY t RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS pv,
        last_value(CASE WHEN ob > 0 AND v >= 0 THEN v END IGNORE NULLS) OVER (PARTITION BY site ORDER BY t RANGE BETWEEN CURRENT ROW AND 3600000000 FOLLOWING) AS nv FROM grid),
    g AS (SELECT site, t, ob, CASE WHEN v IS NOT NULL THEN v WHEN t % 3600000000 = {edge} AND pv IS NOT NULL AND nv IS NULL THEN pv WHEN t % 3600000000 = {edge} AND pv IS NULL AND nv IS NOT NULL THEN nv END AS v FROM f),
    n AS (SELECT *, last_value(v IGNORE NULLS) OVER up AS v0, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER up AS t0, first_value(v IGNORE NULLS) OVER dn AS v1, first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER dn AS t1
        FROM g WINDOW up AS (PARTITION BY site ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), dn AS (PARTITION BY site ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    i AS (SELECT site, t, ob, coalesce(v, v0 + (v1 - v0) * (t - t0) / (t1 - t0)) AS v FROM n),
    vol AS (SELECT site, t + {shift} AS tm, ob, (v + lead(v) OVER w) / 2 * (lead(t) OVER w - t) / 1e6 AS vol FROM i WINDOW w AS (PARTITION BY site ORDER BY t)),
    parts AS (SELECT site, floor(tm / 3600000000)::BIGINT AS h, vol, ob AS l, CASE WHEN tm % 3600000000 <> 0 THEN ob ELSE 0 END AS r FROM vol UNION ALL SELECT site, floor(tm / 3600000000)::BIGINT - 1, NULL, 0, ob FROM vol WHERE tm % 3600000000 = 0 AND ob > 0),
    hours AS (SELECT site, h, coalesce(sum(vol), 0) AS vol, sum(l)::BIGINT AS n_obs, sum(r)::BIGINT AS n_obs_right FROM parts GROUP BY site, h)
--
SELECT site, make_timestamp(h * 3600000000) AS hour, CASE WHEN n_obs + n_obs_right > 0 THEN vol / 3600 END AS value, n_obs, n_obs_right, CAST(n_obs + n_obs_right > 0 AS INTEGER) AS based_on_obs FROM hours JOIN span USING (site) WHERE h * 3600000000 BETWEEN f AND l"""


for _name, _center in (("a1_resample_hourly", False), ("a1_resample_hourly_centred", True)):
    add(_name, lambda s, d, c=_center: T.resample_hourly(obs(s, d), SITE, "ts", "value", c), hourly_sql(_center), "site hour n_obs n_obs_right based_on_obs", "value")


def _quality(s, d):
    return T.hourly_quality(events(s, d), SITE, "ts", "event_type", EVENT_ORDER, {"is_view": F.col("event_type") == "view"})


add("a2_hourly_quality", _quality, f"""e AS (SELECT {SITE_SQL} AS site, epoch_us(ts) AS t, event_type AS c FROM events),
    r AS (SELECT site, t // 3600000000 AS h, c FROM e UNION ALL SELECT site, t // 3600000000 - 1, c FROM e WHERE t % 3600000000 = 0),
    k AS (SELECT site, h, c, coalesce(list_position(['view', 'click', 'cart', 'purchase', 'refund'], c), 0) AS rk FROM r)
--
SELECT site, make_timestamp(h * 3600000000) AS hour, min_by(c, {{'rk': rk, 'c': c}}) AS quality, max(CAST(c = 'view' AS INTEGER)) AS is_view FROM k GROUP BY site, h""", "site hour quality is_view")

add("j10_hour_windows", lambda s, d: T.hour_windows(events(s, d), "ts"), f"""e AS (SELECT event_id, {SITE_SQL} AS site, epoch_us(ts) AS t FROM events)
--
SELECT event_id, site, make_timestamp(t // 3600000000 * 3600000000) AS hour FROM e UNION ALL SELECT event_id, site, make_timestamp((t // 3600000000 - 1) * 3600000000) FROM e WHERE t % 3600000000 = 0""", "event_id site hour")
for _name, _center in (("w4_fill_edges", False), ("w4_fill_edges_centred", True)):
    _head = hourly_sql(_center).rpartition("\n--\n")[0]
    add(_name, lambda s, d, c=_center: T.fill_edges(T.half_hour_marks(obs(s, d), SITE, "ts", "value")[0], SITE, c).select("site", F.timestamp_micros("_t").alias("ts"), F.col("_obs").alias("n_obs"), F.col("_v").alias("value")), f"{_head}\n--\nSELECT site, make_timestamp(t) AS ts, ob AS n_obs, v AS value FROM g", "site ts n_obs", "value")

add("a3_resample_month", lambda s, d: T.resample(flow(s, d), SITE, "day", "month", {"mean": F.avg("q"), "min": F.min("q"), "max": F.max("q"), "total": F.sum("q"), "high": F.bool_or(F.col("q") > 3)}), f"""{FLOW}
--
SELECT site, date_trunc('month', day)::TIMESTAMP AS period, avg(q) AS mean, min(q) AS min, max(q) AS max, sum(q) AS total, bool_or(q > 3) AS high FROM flow GROUP BY ALL""", "site period high", "mean min max total")

add("w3_interpolate_time", lambda s, d: T.interpolate_time(T.reindex_daily(flow(s, d), SITE, "day"), SITE, "day", ["q"]), f"""{FLOW},
    axis AS (SELECT site, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM flow GROUP BY site),
    j AS (SELECT a.site, a.day, epoch(a.day) / 86400 AS t, q, CAST(q IS NULL AS INTEGER) AS is_new FROM axis a LEFT JOIN flow f ON a.site = f.site AND a.day = f.day),
    n AS (SELECT *, last_value(q IGNORE NULLS) OVER up AS v0, last_value(CASE WHEN q IS NOT NULL THEN t END IGNORE NULLS) OVER up AS t0, first_value(q IGNORE NULLS) OVER dn AS v1, first_value(CASE WHEN q IS NOT NULL THEN t END IGNORE NULLS) OVER dn AS t1
        FROM j WINDOW up AS (PARTITION BY site ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), dn AS (PARTITION BY site ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
--
SELECT site, day, is_new, coalesce(q, v0 + (v1 - v0) * (t - t0) / (t1 - t0)) AS q FROM n""", "site day is_new", "q")

add("w5_reindex_daily", lambda s, d: T.reindex_daily(rain(s, d), SITE, "day"), f"""{RAIN},
    axis AS (SELECT site, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM rain GROUP BY site)
--
SELECT a.site, a.day, CAST(p IS NULL AS INTEGER) AS is_new, p, t FROM axis a LEFT JOIN rain r ON a.site = r.site AND a.day = r.day""", "site day is_new", "p t")

for _name, _wy in (("p9_full_years", False), ("p9_full_water_years", True)):
    _m = ((10, 1), (9, 30)) if _wy else ((1, 1), (12, 31))
    add(_name, lambda s, d, wy=_wy: T.full_years(rain(s, d), SITE, "day", wy), f"""{RAIN},
    a AS (SELECT *, max(year(day)) OVER (PARTITION BY site) AS ly FROM rain),
    b AS (SELECT *, min(CASE WHEN month(day) = {_m[0][0]} AND day(day) = {_m[0][1]} AND year(day) < ly THEN day END) OVER (PARTITION BY site) AS st FROM a),
    c AS (SELECT *, max(CASE WHEN month(day) = {_m[1][0]} AND day(day) = {_m[1][1]} AND year(day) > year(st) THEN day END) OVER (PARTITION BY site) AS en FROM b)
--
SELECT site, day, p, t FROM c WHERE en IS NULL OR day BETWEEN st AND en""", "site day", "p t")

add("w10_water_year", lambda s, d: flow(s, d).groupBy("site", S.water_year(F.col("day")).alias("wy")).agg(F.count("*").alias("n")), f"""{FLOW}
--
SELECT site, CAST(year(day) + CAST(month(day) >= 10 AS INTEGER) AS INTEGER) AS wy, count(*) AS n FROM flow GROUP BY ALL""", "site wy n")

RUNS = """c AS (SELECT *, coalesce({cond}, false) AS c FROM {src}),
    n AS (SELECT *, CAST(c IS DISTINCT FROM lag(c) OVER (PARTITION BY site ORDER BY day) AS INTEGER) AS nw, lead(day) OVER (PARTITION BY site ORDER BY day) IS NULL AS la FROM c),
    r AS (SELECT *, sum(nw) OVER (PARTITION BY site ORDER BY day) AS run FROM n),
    runs AS (SELECT site, min(day) AS run_start, count(*) AS length FROM r WHERE c GROUP BY site, run HAVING NOT max(la))"""
STATS = """sh AS (SELECT site, avg(CAST(c AS INTEGER)) * 365.25 AS frequency FROM c GROUP BY site),
    m1 AS (SELECT site, avg(length) AS mean, median(length) AS median, count(*) AS n, avg(length * length) - avg(length) * avg(length) AS v FROM runs GROUP BY site),
    m2 AS (SELECT runs.site, avg(power(length - mean, 3)) AS c3, avg(power(length - mean, 4)) AS c4, avg(power(length - mean, 2)) AS c2 FROM runs JOIN m1 USING (site) GROUP BY runs.site),
    se AS (SELECT site, min_by(s, {{'n': -n, 's': s}}) AS season FROM (SELECT site, CASE WHEN month(day) IN (12, 1, 2) THEN 'djf' WHEN month(day) IN (3, 4, 5) THEN 'mam' WHEN month(day) IN (6, 7, 8) THEN 'jja' ELSE 'son' END AS s, count(*) AS n FROM c WHERE c GROUP BY ALL) GROUP BY site)
--
SELECT site, season, frequency, coalesce(mean, {e}) AS mean, CASE WHEN mean IS NULL THEN {e} ELSE median END AS median, CASE WHEN mean IS NULL THEN {e} WHEN c2 > 0 THEN c3 / power(c2, 1.5) END AS skew, CASE WHEN mean IS NULL THEN {e} WHEN c2 > 0 THEN c4 / (c2 * c2) - 3 END AS kurtosis FROM sh LEFT JOIN m1 USING (site) LEFT JOIN m2 USING (site) LEFT JOIN se USING (site)"""

add("w1_run_lengths", lambda s, d: T.run_lengths(flow(s, d), SITE, "day", F.col("q") > 3), FLOW + ",\n" + RUNS.format(cond="q > 3", src="flow") + "\n--\nSELECT * FROM runs", "site run_start length")
add("a22_period_stats", lambda s, d: T.period_stats(rain(s, d), SITE, "day", {"dry": F.col("p") < 1}), RAIN + ",\n" + RUNS.format(cond="p < 1", src="rain") + ",\n" + STATS.format(e="0.0"), "site season", "frequency mean median skew kurtosis", 4)
for _k, _c in (("no", "q <= 0"), ("low", "q < 0.2 * mq"), ("high", "q > 9 * md")):
    add(f"a23_{_k}_flow", lambda s, d, k=_k: G.flow_periods(flow(s, d), SITE).where(F.col("kind") == k), FLOW + ",\nx AS (SELECT *, avg(q) OVER (PARTITION BY site) AS mq, median(q) OVER (PARTITION BY site) AS md FROM flow),\n" + RUNS.format(cond=_c, src="x") + ",\n" + STATS.format(e="0.0"), "site season", "frequency mean median skew kurtosis", 4)
for _k, _c in (("frost", "t < 273.15"), ("heat", "t > mm + 5"), ("dry", "p < 1"), ("wet", "p >= 5 * mp")):
    add(f"a24_{_k}_periods", lambda s, d, k=_k: C.climate_periods(rain(s, d), SITE).where(F.col("kind") == k), RAIN + """,
    dm AS (SELECT site, strftime(day, '%m-%d') AS md, year(day) AS y, max(t) AS m FROM rain GROUP BY ALL), mx AS (SELECT site, md, avg(m) AS mm FROM dm GROUP BY ALL),
    x AS (SELECT r.*, mm, avg(p) OVER (PARTITION BY r.site) AS mp FROM rain r JOIN mx ON r.site = mx.site AND strftime(r.day, '%m-%d') = mx.md),
""" + RUNS.format(cond=_c, src="x") + ",\n" + STATS.format(e="NULL"), "site season", "frequency mean median skew kurtosis", 4)
add("w6_mean_daily_max", lambda s, d: T.mean_daily_max(rain(s, d), SITE, "day", "t"), f"""{RAIN},
    dm AS (SELECT site, strftime(day, '%m-%d') AS md, year(day) AS y, max(t) AS m FROM rain GROUP BY ALL), mx AS (SELECT site, md, avg(m) AS mean_max FROM dm GROUP BY ALL)
--
SELECT r.site, r.day, mean_max FROM rain r JOIN mx ON r.site = mx.site AND strftime(r.day, '%m-%d') = mx.md""", "site day", "mean_max")
for _k, _a, _z in (("ending", -60, 0), ("starting", 0, 60), ("centred", -30, 30), ("daily", 0, 1440)):
    add(f"p8_bounds_{_k}", lambda s, d, k=_k: T.add_time_bounds(obs(s, d), "ts", k), f"""{OBS}
--
SELECT site, ts, ts + INTERVAL ({_a}) MINUTE AS bounds_start, ts + INTERVAL ({_z}) MINUTE AS bounds_end FROM obs""", "site ts bounds_start bounds_end")


def _cleaned(s, d):
    raw = F.when(F.col("event_type") == "click", "Ice").when(F.col("event_type") == "view", "***").otherwise((F.col("value") - 20).cast("string"))
    return T.clean_flow(table(s, d, "events").select("event_id", raw.alias("q")), "q")


add("p1_clean_flow", _cleaned, "SELECT event_id, CASE WHEN event_type IN ('click', 'view') OR value < 20 THEN NULL ELSE value - 20 END AS q FROM events", "event_id", "q", 4)
add("p2_status_flags", lambda s, d: T.status_flags(table(s, d, "events").withColumn("q", F.when(F.col("event_type") == "click", "ICE").when(F.col("event_type") == "view", "Eqp").otherwise("1")), "q"), "SELECT event_id, CAST(event_type = 'click' AS INTEGER) AS is_ice, CAST(event_type = 'view' AS INTEGER) AS is_malfunction, 0 AS is_backwater FROM events", "event_id is_ice is_malfunction is_backwater")
add("p3_dst_to_lst", lambda s, d: T.dst_to_lst(table(s, d, "events").select("event_id", "ts", (F.col("user_id") % 4).alias("site"), F.when(F.month("ts") % 2 == 0, "EDT").otherwise("EST").alias("tz_cd")).withColumn("tz_cd", F.when(F.col("event_id") % 3 == 0, "EDT").otherwise("EST")), SITE, "ts", "tz_cd"), "SELECT event_id, user_id % 4 AS site, CASE WHEN event_id % 3 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END AS ts FROM events", "event_id site ts")
add("p4_utc_to_lst", lambda s, d: T.utc_to_lst(obs(s, d), "ts", F.when(F.col("site") == 0, F.lit(-3.5)).otherwise(-5.0 - F.col("site")), True), f"{OBS}\n--\nSELECT site, ts + to_hours(CAST(CASE WHEN site = 0 THEN -4 ELSE -5 - site END AS INTEGER)) AS ts, value FROM obs", "site ts", "value")

YEARS = f"{FLOW}, y AS (SELECT *, year(day) + CAST(month(day) >= 10 AS INTEGER) AS wy FROM flow)"
BOTH = f"{FLOW}, {RAIN}, b AS (SELECT f.site, f.day, q, p, year(f.day) + CAST(month(f.day) >= 10 AS INTEGER) AS wy FROM flow f JOIN rain r ON f.site = r.site AND f.day = r.day)"
add("a15_discharge_stats", lambda s, d: G.discharge_stats(flow(s, d), SITE), f"{YEARS}, a AS (SELECT site, wy, avg(q) AS m FROM y GROUP BY ALL)\n--\nSELECT site, count(m) AS n_years, avg(m) AS q_mean, stddev_pop(m) AS q_std FROM a GROUP BY site", "site n_years", "q_mean q_std")
add("a16_runoff_ratio", lambda s, d: G.runoff_ratio(flow(s, d), rain(s, d), SITE), f"{BOTH}, a AS (SELECT site, wy, avg(q) / avg(p) AS r FROM b GROUP BY ALL)\n--\nSELECT site, avg(r) AS ratio_mean, stddev_pop(r) AS ratio_std FROM a GROUP BY site", "site", "ratio_mean ratio_std")
add("a17_elasticity", lambda s, d: G.elasticity(flow(s, d), rain(s, d), SITE), f"{BOTH}, a AS (SELECT site, wy, avg(q) AS q, avg(p) AS p FROM b GROUP BY ALL), m AS (SELECT site, avg(q) AS mq, avg(p) AS mp FROM a GROUP BY site)\n--\nSELECT site, median((q - mq) / nullif(p - mp, 0) * (mp / mq)) AS elasticity FROM a JOIN m USING (site) GROUP BY site", "site", "elasticity", 4)
add("a18_fdc_slope", lambda s, d: G.fdc_slope(flow(s, d), SITE), f"{YEARS}, z AS (SELECT *, avg(q) OVER (PARTITION BY site, wy) AS m FROM y), a AS (SELECT site, wy, (quantile_cont(ln(CASE WHEN q = 0 THEN m / 1000 ELSE q END), 0.66) - quantile_cont(ln(CASE WHEN q = 0 THEN m / 1000 ELSE q END), 0.33)) / 0.33 AS s FROM z GROUP BY site, wy HAVING max(q) > 0)\n--\nSELECT site, avg(s) AS slope_mean, stddev_pop(s) AS slope_std FROM a GROUP BY site", "site", "slope_mean slope_std")
add("a19_flow_quantiles", lambda s, d: G.flow_quantiles(flow(s, d), SITE), f"{YEARS}, a AS (SELECT site, wy, qt, quantile_cont(q, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])[i] AS v FROM y, (SELECT unnest([0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])::DOUBLE AS qt, unnest(range(1, 10)) AS i) GROUP BY site, wy, qt, i)\n--\nSELECT site, qt AS quantile, avg(v) AS mean, stddev_pop(v) AS std FROM a GROUP BY site, qt", "site", "quantile mean std")
EKH = """s AS (SELECT site, day, q, row_number() OVER (PARTITION BY site ORDER BY day) AS i FROM flow),
    e AS (SELECT site, i, day, q, least(q * 0.8, q) AS b FROM s WHERE i = 1 UNION ALL SELECT s.site, s.i, s.day, s.q, least(((1 - 0.8) * 0.98 * e.b + (1 - 0.98) * 0.8 * s.q) / (1 - 0.98 * 0.8), s.q) FROM e JOIN s ON s.site = e.site AND s.i = e.i + 1)"""
add("w7_baseflow_eckhardt", lambda s, d: G.baseflow_eckhardt(flow(s, d), SITE), f"RECURSIVE {FLOW}, {EKH}\n--\nSELECT site, day, q, b FROM e", "site day", "q b")
add("a20_baseflow_index", lambda s, d: G.baseflow_index(flow(s, d), SITE), f"RECURSIVE {FLOW}, {EKH}, a AS (SELECT site, year(day) + CAST(month(day) >= 10 AS INTEGER) AS wy, avg(b) / avg(q) AS i FROM e GROUP BY ALL)\n--\nSELECT site, avg(i) AS bfi_mean, stddev_pop(i) AS bfi_std FROM a GROUP BY site", "site", "bfi_mean bfi_std")
HALF = f"{YEARS}, c AS (SELECT *, sum(q) OVER (PARTITION BY site, wy ORDER BY day) AS c, sum(q) OVER (PARTITION BY site, wy) AS t FROM y), h AS (SELECT site, CAST(wy AS INTEGER) AS wy, min(day) AS half_day FROM c WHERE c / nullif(t, 0) > 0.5 GROUP BY ALL)"
add("w2_half_flow", lambda s, d: G.half_flow(flow(s, d), SITE), f"{HALF}\n--\nSELECT * FROM h", "site wy half_day")
add("a21_half_flow_date", lambda s, d: G.half_flow_date(flow(s, d), SITE), f"{HALF}, x AS (SELECT site, avg(sin({by_doy('dayofyear(half_day)')})) AS sn, avg(cos({by_doy('dayofyear(half_day)')})) AS cs FROM h GROUP BY site)\n--\nSELECT site, ((atan2(sn, cs) * 366 / (2 * pi()) % 366) + 366) % 366 AS hfd_mean, sqrt(-2 * ln(least(sqrt(sn * sn + cs * cs), 1.0))) * 366 / (2 * pi()) AS hfd_std FROM x", "site", "hfd_mean hfd_std")
add("a7_circular_direction", lambda s, d: rain(s, d).groupBy("site").agg(S.circular_mean(S.wind_direction(F.col("p") - 3, F.col("t") - 273)).alias("mean"), S.circular_std(S.wind_direction(F.col("p") - 3, F.col("t") - 273)).alias("std")), f"{RAIN}, w AS (SELECT site, 180 + degrees(atan2(p - 3, t - 273)) AS d FROM rain), x AS (SELECT site, avg(sin(radians(d))) AS sn, avg(cos(radians(d))) AS cs FROM w GROUP BY site)\n--\nSELECT site, (degrees(atan2(sn, cs)) + 360) % 360 AS mean, degrees(sqrt(-2 * ln(sqrt(sn * sn + cs * cs)))) AS std FROM x", "site", "mean std", 5)

ANNUAL = f"""{RAIN}, y AS (SELECT site, year(day) AS y, avg(p) * 365.25 AS p, avg(pet) * 365.25 AS pet, avg(t) AS t, avg(CASE WHEN t < 273.15 THEN p ELSE 0 END) * 365.25 AS snow FROM rain GROUP BY ALL)
--
SELECT site, count(*) AS n_years, avg(p) AS p_mean, stddev_pop(p) AS p_std, avg(pet) AS pet_mean, stddev_pop(pet) AS pet_std, avg(t) AS t_mean, stddev_pop(t) AS t_std, avg(pet / p) AS aridity_mean, stddev_pop(pet / p) AS aridity_std, avg(snow / p) AS fsnow_mean, stddev_pop(snow / p) AS fsnow_std FROM y GROUP BY site"""
add("a4_annual_climate", lambda s, d: C.annual_climate(rain(s, d), SITE), ANNUAL, "site n_years", "p_mean p_std pet_mean pet_std t_mean t_std aridity_mean aridity_std fsnow_mean fsnow_std")
add("a5_monthly_climatology", lambda s, d: C.monthly_climatology(rain(s, d), SITE, "t"), f"""{RAIN}, m AS (SELECT site, year(day) AS y, CAST(month(day) AS INTEGER) AS month, avg(t) AS a FROM rain GROUP BY ALL)
--
SELECT site, month, avg(a) AS mean_mean, stddev_pop(a) AS mean_std, avg(a) AS min_mean, stddev_pop(a) AS min_std, avg(a) AS max_mean, stddev_pop(a) AS max_std FROM m GROUP BY ALL""", "site month", "mean_mean mean_std min_mean min_std max_mean max_std")
add("a6_monthly_ratio", lambda s, d: C.monthly_ratio(rain(s, d), SITE), f"""{RAIN}, m AS (SELECT site, year(day) AS y, CAST(month(day) AS INTEGER) AS month, CASE WHEN sum(p) = 0 THEN 1 ELSE sum(p) END AS p, sum(pet) AS pet, sum(CASE WHEN t < 273.15 THEN p ELSE 0 END) AS snow FROM rain GROUP BY ALL)
--
SELECT site, month, avg(pet / p) AS aridity_mean, stddev_pop(pet / p) AS aridity_std, avg(snow / p) AS fsnow_mean, stddev_pop(snow / p) AS fsnow_std FROM m GROUP BY ALL""", "site month", "aridity_mean aridity_std fsnow_mean fsnow_std")


def season_sql(src: str, group: str) -> str:
    return f"""{RAIN}, {src}, y AS (SELECT site, y, count(p) AS c, max(n) AS n, avg(p) AS m, 2 * avg(p * sin(x)) AS ps, 2 * avg(p * cos(x)) AS pc, 2 * avg(t * sin(x)) AS ts, 2 * avg(t * cos(x)) AS tc FROM x GROUP BY site, y),
    z AS (SELECT site, CASE WHEN c = n THEN (ps * ts + pc * tc) / nullif(m * sqrt(ts * ts + tc * tc), 0) END AS s FROM y)
--
SELECT site, count(s) AS n_years, avg(s) AS seasonality_mean, stddev_pop(s) AS seasonality_std FROM z GROUP BY site"""


INTERPOLATED = """axis AS (SELECT site, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM rain GROUP BY site),
    j AS (SELECT a.site, a.day, epoch(a.day) / 86400 AS k, p, t FROM axis a LEFT JOIN rain f ON a.site = f.site AND a.day = f.day),
    nb AS (SELECT *, last_value(p IGNORE NULLS) OVER u AS p0, first_value(p IGNORE NULLS) OVER d AS p1, last_value(t IGNORE NULLS) OVER u AS t0, first_value(t IGNORE NULLS) OVER d AS t1,
        last_value(CASE WHEN p IS NOT NULL THEN k END IGNORE NULLS) OVER u AS k0, first_value(CASE WHEN p IS NOT NULL THEN k END IGNORE NULLS) OVER d AS k1
        FROM j WINDOW u AS (PARTITION BY site ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), d AS (PARTITION BY site ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    x AS (SELECT site, year(day) AS y, coalesce(p, p0 + (p1 - p0) * (k - k0) / (k1 - k0)) AS p, coalesce(t, t0 + (t1 - t0) * (k - k0) / (k1 - k0)) AS t, CASE WHEN year(day) % 4 = 0 THEN 366 ELSE 365 END AS n, 2 * pi() * (dayofyear(day) - 1) / CASE WHEN year(day) % 4 = 0 THEN 366 ELSE 365 END AS x FROM nb)"""
add("a8_seasonality", lambda s, d: C.seasonality(T.interpolate_time(T.reindex_daily(rain(s, d), SITE, "day"), SITE, "day", ["p", "t"]), SITE), season_sql(INTERPOLATED, ""), "site n_years", "seasonality_mean seasonality_std")
add("a8_seasonality_years", lambda s, d: C.seasonality(rain(s, d), SITE), season_sql("x AS (SELECT site, year(day) AS y, p, t, CASE WHEN year(day) % 4 = 0 THEN 366 ELSE 365 END AS n, 2 * pi() * (dayofyear(day) - 1) / CASE WHEN year(day) % 4 = 0 THEN 366 ELSE 365 END AS x FROM rain)", ""), "site n_years", "seasonality_mean seasonality_std")
add("a8_seasonality_typical", lambda s, d: C.seasonality(rain(s, d), SITE, typical=True), season_sql("ty AS (SELECT site, 0 AS y, dayofyear(day) AS i, avg(p) AS p, avg(t) AS t FROM rain GROUP BY ALL), x AS (SELECT site, y, p, t, max(i) OVER (PARTITION BY site) AS n, 2 * pi() * (i - 1) / max(i) OVER (PARTITION BY site) AS x FROM ty)", ""), "site n_years", "seasonality_mean seasonality_std")
add("a25_number_of_years", lambda s, d: rain(s, d).groupBy("site").agg(F.count_distinct(F.year("day")).alias("n_years"), F.count_distinct(S.water_year(F.col("day"))).alias("n_water_years")), f"{RAIN}\n--\nSELECT site, count(DISTINCT year(day)) AS n_years, count(DISTINCT year(day) + CAST(month(day) >= 10 AS INTEGER)) AS n_water_years FROM rain GROUP BY site", "site n_years n_water_years")
add("a26_pet_comparison", lambda s, d: C.pet_comparison({"one": rain(s, d), "two": rain(s, d).withColumn("pet", F.col("pet") - 3.8)}, SITE), f"""{RAIN}, u AS (SELECT 'one' AS source, site, day, p, pet FROM rain UNION ALL SELECT 'two', site, day, p, pet - 3.8 FROM rain), y AS (SELECT source, site, year(day) AS y, avg(pet) AS a FROM u GROUP BY ALL), a AS (SELECT source, site, avg(a) AS pet_annual FROM y GROUP BY ALL)
--
SELECT source, site, count(*) FILTER (pet < 0) AS n_negative, avg(pet) AS pet_mean, avg(p) AS p_mean, any_value(pet_annual) AS pet_annual, avg(pet) / avg(p) AS aridity FROM u JOIN a USING (source, site) GROUP BY source, site""", "source site n_negative", "pet_mean p_mean pet_annual aridity")

# Scalar functions, on the daily rain table.
EPS = "(2.871 / 4.61)"
ES = "CASE WHEN t > 273.15 THEN 611.2 * exp(17.62 * (t - 273.15) / (t - 273.15 + 243.12)) ELSE 611.2 * exp(22.46 * (t - 273.15) / (t - 273.15 + 272.62)) END"
COL = F.col
for _n, _c, _sql in (
    ("m1_vapor_pressure", lambda: S.vapor_pressure(F.lit(90000.0), COL("p") / 1000), f"-(p / 1000) * 90000 / ((p / 1000) * {EPS} - p / 1000 - {EPS})"),
    ("m1_vapor_pressure_approximate", lambda: S.vapor_pressure(F.lit(90000.0), COL("p") / 1000, True), f"(p / 1000) * 90000 / {EPS}"),
    ("m2_relative_humidity", lambda: S.relative_humidity(F.greatest(COL("t"), F.lit(200.0)), COL("p") * 100), f"greatest(least(p * 100 / ({ES.replace('t ', 'greatest(t, 200.0) ')}), 1.0), 0.0)"),
    ("m3_wind_speed", lambda: S.wind_speed(COL("p"), COL("pet")), "sqrt(p * p + pet * pet)"),
    ("m3_wind_direction", lambda: S.wind_direction(COL("p") - 3, COL("pet") - 3.8), "(180 + degrees(atan2(p - 3, pet - 3.8)) + 360) % 360"),
    ("m4_penman_monteith", lambda: S.penman_monteith(COL("t"), F.lit(90000.0), COL("p"), F.lit(500.0), COL("pet") * 100, F.lit(300.0)), "(0.408 * sl * ((0.77 * pet * 100 - (300.0 - 0.95 * 5.670374419e-8 * t * t * t * t)) * 0.0036) + ga * (37.0 / t) * p * 4.87 / ln(67.8 * 10 - 5.42) * (es - 0.5)) / (sl + ga * (1 + 0.34 * p * 4.87 / ln(67.8 * 10 - 5.42)))"),
    ("m6_oudin", lambda: S.oudin(COL("t") - 273.15, COL("pet") * 8, F.lit(30)), "CASE WHEN t - 268.15 > 0 THEN pet * 8 / 2.45 * (t - 268.15) / 100 * 30 ELSE 0 END"),
    ("m9_net_radiation", lambda: S.net_radiation(COL("pet"), S.reflected_shortwave(COL("pet"), COL("p")), COL("t"), COL("p")), "pet - (pet - p) + t - p"),
    ("m10_km_to_degrees", lambda: S.km_to_degrees(COL("p"), COL("pet") * 10)[1], "p / (111 * cos(radians(pet * 10)))"),
):
    add(_n, lambda s, d, c=_c: rain(s, d).select("site", "day", c().alias("x")), f"""{RAIN}, e AS (SELECT *, 0.6108 * exp(17.27 * (t - 273.15) / (t - 273.15 + 237.3)) AS es, 0.000665 * 90 AS ga FROM rain), r AS (SELECT *, 4098.0 * es / ((t - 273.15 + 237.3) * (t - 273.15 + 237.3)) AS sl FROM e)
--
SELECT site, day, {_sql} AS x FROM r""", "site day", "x", 5)
add("m5_priestley_taylor", lambda s, d: rain(s, d).select("site", "day", S.priestley_taylor(COL("t") - 273.15, COL("pet") * 3, F.lit(50.0), F.dayofyear("day"), F.lit(200.0)).alias("x")), f"""{RAIN},
    a AS (SELECT site, day, t - 273.15 AS t, pet * 3 AS sr, 1 + 0.033 * cos(2 * pi() / 365 * dayofyear(day)) AS di, 0.409 * sin(2 * pi() / 365 * dayofyear(day) - 1.39) AS de FROM rain),
    b AS (SELECT *, acos(least(greatest(-tan(radians(50)) * tan(de), -1.0), 1.0)) AS an, 0.6108 * exp(17.27 * t / (t + 237.3)) AS es FROM a),
    c AS (SELECT *, (0.75 + 2e-5 * 200) * 24 * 60 / pi() * 0.082 * di * (an * sin(radians(50)) * sin(de) + cos(radians(50)) * cos(de) * sin(an)) AS cl, 4098.0 * es / ((t + 237.3) * (t + 237.3)) AS sl, 0.000665 * 101.3 * power((293 - 0.0065 * 200) / 293, 5.26) AS ga FROM b)
--
SELECT site, day, greatest(1.26 * sl / (sl + ga) * (0.77 * sr - 4.903e-9 * power(t + 273.16, 4) * (0.34 - 0.14 * sqrt(es)) * (1.35 * CASE WHEN cl > 0 THEN least(sr / cl, 1.0) ELSE 0 END - 0.35)) / 2.45, 0.0) AS x FROM c""", "site day", "x", 5)
