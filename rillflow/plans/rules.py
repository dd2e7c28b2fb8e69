"""Queries that meet the hard cases of single rules: edges of tolerances and periods, codes of both countries, sub-daily
steps, absent columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillflow.operators import climate as C
from rillflow.operators import forcing as O
from rillflow.operators import tables as B
from rillflow.operators import timeseries as T
from rillflow.plans.adapters import FLOW, NET, PIXELS, RAIN, SITE_SQL, add, events, flow, net, pixels, rain, table
from rillflow.operators import network as N
from rillflow.operators import rasters as R
from rillflow.operators.mergeable import Mergeable
from rillflow.operators import cubes as Q
from rillflow.plans.grids import CELLS, FORC, UPSQL, WEIGHTS, cells, forc, wts
from rillflow.plans.records import AVAIL, availability
from rillflow.plans.series import RUNS, STATS

COL, SITE = F.col, ["site"]

# J3: offsets beyond a rounding edge, references that lie side by side, and cells without one.
def _shifted(df, by):
    return df.withColumns({c: COL(c) + by for c in ("lon", "lat")})


def _references(s, d):
    own = cells(s, d).where("cell % 3 = 0").select("lon", "lat")
    return own.unionByName(_shifted(own, 2e-7))


add("j3_align_edges", lambda s, d: O.align_coords(_shifted(cells(s, d), 4.96e-5), _references(s, d), ["lon", "lat"], 5e-5), f"""{CELLS}, own AS (SELECT DISTINCT lon, lat FROM cells WHERE cell % 3 = 0), r AS (SELECT * FROM own UNION ALL SELECT lon + 2e-7, lat + 2e-7 FROM own),
    m AS (SELECT cell, r.lon, r.lat, (c.lon + 4.96e-5 - r.lon) ** 2 + (c.lat + 4.96e-5 - r.lat) ** 2 AS d FROM cells c JOIN r ON round(c.lon, 1) = round(r.lon, 1) AND round(c.lat, 1) = round(r.lat, 1))
--
SELECT cell, arg_min(lon, d) AS lon, arg_min(lat, d) AS lat FROM m GROUP BY cell""", "cell", "lon lat", 8)
add("p10_wrap_latitude", lambda s, d: O.wrap_latitude(cells(s, d).withColumn("lat", COL("lat") + 45), "lat"), f"{CELLS}\n--\nSELECT cell, CASE WHEN lat + 45 > 90 THEN lat - 135 ELSE lat + 45 END AS lat FROM cells", "cell", "lat")

# P5: every variable of the data set, those without a rule too.
RDRS = {"A_PR0_SFC": "p", "P_FB_SFC": "t", "P_P0_SFC": "t", "P_TT_1.5m": "t", "P_UUC_10m": "p", "P_VVC_10m": "t", "P_UVC_10m": "pet", "P_HU_1.5m": "pet"}


def _rdrs(s, d):
    rows = rain(s, d).select("site", "day", *[COL(c).alias(f"RDRS_v2.1_{v}") for v, c in RDRS.items()])
    return O.convert_units(rows, O.RULES["RDRS"]).select("site", "day", *[COL(f"`RDRS_v2.1_{v}`").alias(v.replace(".", "_").lower()) for v in RDRS])


add("p5_rdrs_units", _rdrs, f"{RAIN}\n--\nSELECT site, day, p / 3.6 AS a_pr0_sfc, t AS p_fb_sfc, t * 100 AS p_p0_sfc, t + 273.15 AS p_tt_1_5m, p * 0.514 AS p_uuc_10m, t * 0.514 AS p_vvc_10m, pet * 0.514 AS p_uvc_10m, pet AS p_hu_1_5m FROM rain", "site day", " ".join(v.replace(".", "_").lower() for v in RDRS), 5)

# P13: the boundary day counts; one layer a day, so that it exists.
for _name, _last, _sql in (("years", {"last_years": 2}, "2 YEAR"), ("months", {"last_months": 7}, "7 MONTH"), ("days", {"last_days": 100}, "100 DAY")):
    add(f"p13_last_{_name}", lambda s, d, k=_last: B.filter_dates(rain(s, d).groupBy("day").agg(F.sum("p").alias("p")), "day", **k), f"{RAIN}\n--\nSELECT day, sum(p) AS p FROM rain WHERE day >= (SELECT max(day) FROM rain) - INTERVAL {_sql} GROUP BY day", "day", "p", 4)


# A2, P2: Canadian approvals and grades, and daily symbols.
STATES = ("Provisional/Provisoire", "Final/Finales", None, "Preliminary", "Reviewed", "Approved", "Unlisted")
GRADES = (0, 40, 10, 20, 30, None, -1, 50)


def _graded(s, d):
    pick = lambda values, c: F.get(F.array(*[F.lit(v) for v in values]), (c % len(values)).cast("int"))
    return events(s, d).select("site", "ts", pick(STATES, COL("event_id")).alias("approval"), pick(GRADES, F.floor(COL("event_id") / 3)).alias("grade"))


def _listed(values):
    return "[" + ", ".join("NULL" if v is None else repr(v) for v in values) + "]"


add("a2_hourly_quality_can", lambda s, d: T.hourly_quality_can(_graded(s, d), SITE, "ts", "approval", "grade"), f"""e AS (SELECT {SITE_SQL} AS site, epoch_us(ts) AS t, {_listed(STATES)}[1 + event_id % 7] AS a, {_listed(GRADES)}[1 + event_id // 3 % 8] AS g FROM events),
    x AS (SELECT *, coalesce(a, 'nan') || ':' || coalesce(CAST(g AS VARCHAR), 'nan') AS c FROM e),
    r AS (SELECT site, t // 3600000000 AS h, c, g FROM x UNION ALL SELECT site, t // 3600000000 - 1, c, g FROM x WHERE t % 3600000000 = 0),
    k AS (SELECT *, coalesce(list_position({_listed(T.WSC_ORDER)}, c), 0) AS rk FROM r)
--
SELECT site, make_timestamp(h * 3600000000) AS hour, min_by(c, {{'rk': rk, 'c': c}}) AS quality, max(CAST(coalesce(g = 10, false) AS INTEGER)) AS is_ice FROM k GROUP BY site, h""", "site hour quality is_ice")
add("p2_status_flags_can", lambda s, d: T.status_flags(table(s, d, "events").withColumn("symbol", F.get(F.array(*[F.lit(v) for v in ("A", "B", "D", "E", "S", None, " ")]), (COL("event_id") % 7).cast("int"))), "symbol", T.CAN_SYMBOLS), "SELECT event_id, CAST(event_id % 7 = 0 AS INTEGER) AS is_partial_day, CAST(event_id % 7 = 1 AS INTEGER) AS is_ice_affected, CAST(event_id % 7 = 2 AS INTEGER) AS is_dry_day, CAST(event_id % 7 = 3 AS INTEGER) AS is_estimated_value FROM events", "event_id is_partial_day is_ice_affected is_dry_day is_estimated_value")


# A24: two steps a day, the later one warmer; a hot later step makes both hot.
def _halves(s, d):
    step = F.explode(F.array(*[F.struct(F.lit(h).alias("h"), F.lit(t).alias("dt"), F.lit(p).alias("share")) for h, t, p in ((0, -3.0, 0.25), (12, 4.0, 0.75))]))
    rows = rain(s, d).select("site", "day", "p", "t", step.alias("x"))
    return rows.select("site", F.timestamp_micros(F.unix_micros(COL("day").cast("timestamp")) + COL("x.h") * F.lit(3_600_000_000)).cast("timestamp_ntz").alias("ts"), (COL("p") * COL("x.share")).alias("p"), (COL("t") + COL("x.dt")).alias("t"))


HALVES = f"{RAIN}, hv AS (SELECT site, day AS dy, CAST(day AS TIMESTAMP) + to_hours(h) AS day, p * share AS p, t + dt AS t FROM rain, (VALUES (0, -3.0, 0.25), (12, 4.0, 0.75)) AS x(h, dt, share)), dd AS (SELECT site, dy, sum(p) AS p, max(t) AS t FROM hv GROUP BY ALL), mx AS (SELECT site, strftime(dy, '%m-%d') AS md, avg(t) AS mm FROM dd GROUP BY ALL), ht AS (SELECT dd.site, dy, dd.t > mm + 5 AS hot FROM dd JOIN mx ON dd.site = mx.site AND strftime(dy, '%m-%d') = md)"
STEPS = STATS.replace("avg(length) AS mean, median(length) AS median, count(*) AS n, avg(length * length) - avg(length) * avg(length) AS v FROM runs", "avg(length / 2) AS mean, median(length / 2) AS median, count(*) AS n FROM runs").replace("power(length - mean, ", "power(length / 2 - mean, ")
for _k, _x, _c, _s in (("frost", "hv", "t < 273.15", STEPS), ("heat", "(SELECT hv.*, hot FROM hv JOIN ht USING (site, dy))", "hot", STEPS), ("dry", "(SELECT site, dy AS day, p FROM dd)", "p < 1", STATS), ("wet", "(SELECT site, dy AS day, p, avg(p) OVER (PARTITION BY site) AS mp FROM dd)", "p >= 5 * mp", STATS)):
    add(f"a24_{_k}_periods_subdaily", lambda s, d, k=_k: C.climate_periods(_halves(s, d), SITE, "ts", 2).where(COL("kind") == k), HALVES + ",\n" + RUNS.format(cond=_c, src=_x) + ",\n" + _s.format(e="NULL"), "site season", "frequency mean median skew kurtosis", 4)


# W5: hourly axes, status defaults, leap days.
def _hourly(s, d):
    hour = F.date_trunc("hour", COL("ts").cast("timestamp"))
    rows = events(s, d).where("site = 0").groupBy("site", hour.alias("ts")).agg(F.avg("value").alias("q"), F.min("event_type").alias("quality"))
    rows = rows.withColumns({"q": F.when(F.hour("ts") % 5 != 0, COL("q")), "is_ice": F.lit(1)})
    return T.reindex(rows, SITE, "ts", "1 HOUR", "q", ["is_ice"], ["quality"])


add("w5_reindex_hourly", _hourly, f"""e AS (SELECT {SITE_SQL} AS site, date_trunc('hour', ts)::TIMESTAMP AS ts, value, event_type FROM events), h AS (SELECT site, ts, avg(CASE WHEN hour(ts) % 5 <> 0 THEN value END) AS q, min(event_type) AS quality FROM e WHERE site = 0 GROUP BY ALL),
    axis AS (SELECT site, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM h GROUP BY site)
--
SELECT site, ts, q, CASE WHEN q IS NOT NULL THEN quality END AS quality, CAST(q IS NOT NULL AS INTEGER) AS is_ice, CAST(h.ts IS NULL AS INTEGER) AS is_new FROM axis LEFT JOIN h USING (site, ts)""", "site ts quality is_ice is_new", "q")


def _leap(s, d):
    rows = rain(s, d).where("month(day) IN (1, 12) AND NOT (month(day) = 12 AND day(day) = 31 AND year(day) % 4 = 0)").select("site", "day", "t")
    return T.add_leap_days(rows, SITE, "day", ["t"])


add("w5_add_leap_days", _leap, f"""{RAIN}, r AS (SELECT site, day, t FROM rain WHERE month(day) IN (1, 12) AND NOT (month(day) = 12 AND day(day) = 31 AND year(day) % 4 = 0)),
    y AS (SELECT site, min(day) AS a, max(day) AS z, unnest(generate_series(year(min(day)), year(max(day)))) AS y FROM r GROUP BY site),
    n AS (SELECT site, make_date(y, 12, 31) AS day FROM y WHERE y % 4 = 0 AND make_date(y, 12, 31) > a AND make_date(y, 12, 31) < z),
    b AS (SELECT n.site, n.day, max(r.day) FILTER (r.day < n.day) AS d0, min(r.day) FILTER (r.day > n.day) AS d1 FROM n JOIN r ON r.site = n.site GROUP BY ALL)
--
SELECT site, day, CAST(dayofyear(day) AS INTEGER) AS yearday, 0 AS is_new, t FROM r UNION ALL
SELECT b.site, b.day, CAST(dayofyear(b.day) AS INTEGER), 1, p.t + (q.t - p.t) * date_diff('day', d0, b.day) / date_diff('day', d0, d1) FROM b JOIN r p ON p.site = b.site AND p.day = d0 JOIN r q ON q.site = b.site AND q.day = d1""", "site day yearday is_new", "t")

# J13, A27, A28.
add("j13_compare_categories", lambda s, d: O.compare_categories(flow(s, d).select("site", "day", F.when(COL("q") > 3, "high").alias("c")), flow(s, d).where("dayofmonth(day) <> 3").select("site", "day", F.when(COL("q") > 2.5, "high").otherwise(F.when(F.month("day") == 1, "")).alias("c")), SITE, "day", "c"), f"{FLOW}, b AS (SELECT site, coalesce(CASE WHEN q > 3 THEN 'high' END, '') AS a, coalesce(CASE WHEN q > 2.5 THEN 'high' END, '') AS b FROM flow WHERE day(day) <> 3)\n--\nSELECT site, count(*) AS n_common, count(*) FILTER (a <> b) AS n_different FROM b GROUP BY site", "site n_common n_different")
add("a27_availability_counts", lambda s, d: B.availability_counts(availability(s, d), (0.5, 0.99), (0.02, 0.05)), f"{AVAIL}, x AS (SELECT (dur - n) / dur AS ms, n / 365.25 AS ny FROM av)\n--\nSELECT 'missing_share' AS measure, 0.0 AS threshold, count(*) FILTER (ms = 0) AS n FROM x UNION ALL SELECT 'missing_share', unnest([0.5, 0.99]), unnest([count(*) FILTER (ms < 0.5), count(*) FILTER (ms < 0.99)]) FROM x UNION ALL SELECT 'net_years', unnest([0.02, 0.05]), unnest([count(*) FILTER (ny < 0.02), count(*) FILTER (ny < 0.05)]) FROM x", "measure n", "threshold")


def _months(s, d):
    rows = rain(s, d).where("NOT (site % 2 = 0 AND year(day) = 1996 AND month(day) = 5)").select("site", COL("day").cast("timestamp").alias("ts"), "p")
    return O.check_forcing(rows, SITE, "ts", ["p", "phi"], 86400, months=True).where("reason IN ('absent phi', 'missing months')")


add("a28_absent_and_months", _months, f"{RAIN}, m AS (SELECT site, count(DISTINCT date_trunc('month', day)) AS n, date_diff('month', min(day), max(day)) + 1 AS w FROM rain WHERE NOT (site % 2 = 0 AND year(day) = 1996 AND month(day) = 5) GROUP BY site)\n--\nSELECT site, 'absent phi' AS reason FROM m UNION ALL SELECT site, 'missing months' FROM m WHERE n < w", "site reason")

# G2: sets by interval labels. F1: states that merge.
add("g2_upstream_sets", lambda s, d: N.upstream_sets(net(s, d), net(s, d).select("basin", "comid")), f"RECURSIVE {NET}, {UPSQL}\n--\nSELECT CAST(0 AS INTEGER) AS basin, comid, member FROM up", "basin comid member")
add("g2_tour", lambda s, d: N.tour(net(s, d)).withColumn("n_up", COL("exit") - COL("entry") + 1), f"RECURSIVE {NET}, {UPSQL}\n--\nSELECT CAST(0 AS INTEGER) AS basin, comid, CAST(1 AS BIGINT) AS root, count(*) AS n_up FROM up GROUP BY comid", "basin comid root n_up")
MOMENTS = Mergeable(lambda: (0, 0.0, 0.0, 0.0), lambda s, v: (s[0] + len(v), s[1] + v.sum(), s[2] + (v**2).sum(), s[3] + (v**3).sum()), lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True)), lambda s: None if not s[0] else (s[3] / s[0] - 3 * s[1] / s[0] * s[2] / s[0] + 2 * (s[1] / s[0]) ** 3) / (s[2] / s[0] - (s[1] / s[0]) ** 2) ** 1.5)
add("f1_mergeable_stats", lambda s, d: R.zonal_stats(pixels(s, d), ["zone"], mergeable={"skew": MOMENTS}), f"{PIXELS}, m AS (SELECT zone, avg(value) AS m FROM pix GROUP BY zone)\n--\nSELECT zone, count(value) AS n, avg(power(value - m, 3)) / power(avg(power(value - m, 2)), 1.5) AS skew FROM pix JOIN m USING (zone) GROUP BY zone", "zone n", "skew")

# J2, J4: three cubes of one variable each, in buckets of cells, merged and remapped where they lie.
THREE = {"t": "true", "p": "day(day) <> 5", "pet": "cell % 13 <> 0"}


def _cubes(s, d):
    own = forc(s, d).withColumn("pet", COL("t") / COL("p"))
    return [own.where(w).select("cell", "day", v) for v, w in THREE.items()]


add("j4_remap_cubes", lambda s, d: Q.remap_cubes(_cubes(s, d), wts(s, d), ["cell", "day"], list(THREE), 8), f"{FORC}, {WEIGHTS}\n--\nSELECT hru, day, sum(w * t) / sum(w) AS t, sum(w * p) / sum(w) AS p, sum(w * t / p) / sum(w) AS pet FROM forc JOIN wts USING (cell) WHERE day(day) <> 5 AND cell % 13 <> 0 GROUP BY ALL", "hru day", "t p pet")
