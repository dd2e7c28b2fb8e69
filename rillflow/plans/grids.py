"""Queries of rasters, forcing, geometry and river networks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillflow.functions import scalars as S
from rillflow.functions.legends import LEGENDS
from rillflow.operators import forcing as O
from rillflow.operators import geometry as X
from rillflow.operators import network as N
from rillflow.operators import rasters as R
from rillflow.plans.adapters import FLOW, NET, PIXELS, RAIN, add, flow, net, pixels, rain, table

COL = F.col

# Rasters: pixels of the embeddings table, zones by label.
add("a9_zonal_stats", lambda s, d: R.zonal_stats(pixels(s, d), ["zone"], extra={"p90": F.percentile("value", 0.9), "span": F.max("value") - F.min("value")}), f"""{PIXELS}
--
SELECT zone, count(value) AS n, min(value) AS min, avg(value) AS mean, max(value) AS max, stddev_pop(value) AS std, quantile_cont(value, 0.9) AS p90, max(value) - min(value) AS span FROM pix GROUP BY zone""", "zone n", "min mean max std p90 span")
add("a10_harmonic_mean", lambda s, d: R.zonal_stats(pixels(s, d).withColumn("value", F.abs("value") + 1), ["zone"]), f"{PIXELS}\n--\nSELECT zone, count(*) / sum(1 / (abs(value) + 1)) AS harmonic_mean FROM pix GROUP BY zone", "zone", "harmonic_mean")
add("a11_class_fractions", lambda s, d: R.class_fractions(pixels(s, d).withColumn("value", F.floor(F.abs("value") * 20)), "zone", [0, 1, 2, 3, 4, 99]), f"""{PIXELS}, c AS (SELECT zone, CAST(floor(abs(value) * 20) AS INTEGER) AS class FROM pix)
--
SELECT z.zone, l.class, count(c.class) FILTER (c.class = l.class) / any_value(z.n) AS fraction FROM (SELECT zone, count(*) AS n FROM c GROUP BY zone) z, (SELECT CAST(unnest([0, 1, 2, 3, 4, 99]) AS INTEGER) AS class) l LEFT JOIN c ON c.zone = z.zone AND c.class = l.class GROUP BY z.zone, l.class""", "zone class", "fraction")
for _name, _legend in (("glclu", "GLCLU 2019"), ("mcd12q1", "MCD12Q1.061"), ("lgrip30", "LGRIP30")):
    _names = ", ".join(f"({k}, 'x_{n}_fraction')" for k, n in LEGENDS[_legend].items())
    add(f"a11_{_name}", lambda s, d, g=_legend: R.class_fractions(pixels(s, d).withColumn("value", F.floor(F.abs("value") * 40)), "zone", LEGENDS[g], prefix="x_"), f"""{PIXELS}, c AS (SELECT zone, CAST(floor(abs(value) * 40) AS INTEGER) AS class FROM pix), n AS (SELECT zone, count(*) AS n FROM c GROUP BY zone), k AS (SELECT zone, class, count(*) AS k FROM c GROUP BY ALL), l(class, attribute) AS (VALUES {_names})
--
SELECT n.zone, l.attribute, coalesce(k, 0) / n AS fraction FROM n CROSS JOIN l LEFT JOIN k ON k.zone = n.zone AND k.class = l.class""", "zone attribute", "fraction")
add("f1_user_stats", lambda s, d: R.zonal_stats(pixels(s, d), ["zone"], extra={"positive": F.count_if(COL("value") > 0)}, functions={"to_median": lambda v: float(v.max() - v.median())}), f"{PIXELS}\n--\nSELECT zone, count(*) FILTER (value > 0) AS positive, max(value) - median(value) AS to_median FROM pix GROUP BY zone", "zone positive", "to_median")
add("a12_weighted_stats", lambda s, d: R.weighted_stats(pixels(s, d).withColumn("w", 1 + COL("col") % 5), ["zone"], "value", "w"), f"""{PIXELS}, w AS (SELECT zone, value AS v, 1 + col % 5 AS w FROM pix)
--
SELECT zone, min(v) AS min, sum(v * w) / sum(w) AS mean, max(v) AS max, sqrt(sum(w * v * v) / sum(w) - (sum(v * w) / sum(w)) * (sum(v * w) / sum(w))) AS std FROM w GROUP BY zone""", "zone", "min mean max std")
add("a14_stack_mean", lambda s, d: R.stack_composite(pixels(s, d).withColumn("month", COL("row") % 12), "mean", ["col", "month"], low=-0.1, high=0.2), f"{PIXELS}\n--\nSELECT col, row % 12 AS month, avg(value) AS value FROM pix WHERE value BETWEEN -0.1 AND 0.2 GROUP BY ALL", "col month", "value")
add("a14_stack_mode", lambda s, d: R.stack_composite(pixels(s, d).withColumn("value", F.floor(COL("value") * 20)), "mode", ["col"]), f"{PIXELS}, c AS (SELECT col, floor(value * 20) AS value, count(*) AS n FROM pix GROUP BY ALL)\n--\nSELECT col, min_by(value, {{'n': -n, 'v': value}}) AS value FROM c GROUP BY col", "col", "value")
LAYERS = "lay AS (SELECT DISTINCT label AS layer, CASE WHEN label % 3 = 0 THEN NULL ELSE -0.5 * label END AS scale, CASE WHEN label % 2 = 0 THEN NULL ELSE 3.0 END AS off FROM embeddings)"


def _scaled(s, d):
    layers = pixels(s, d).select(COL("zone").alias("layer")).distinct().select("layer", F.when(COL("layer") % 3 != 0, -0.5 * COL("layer")).alias("scale"), F.when(COL("layer") % 2 != 0, 3.0).alias("offset"))
    return R.apply_scale(R.zonal_stats(pixels(s, d), ["zone"]).withColumnRenamed("zone", "layer"), layers, ["mean"], ["std"])


add("p6_apply_scale", _scaled, f"{PIXELS}, {LAYERS}\n--\nSELECT zone AS layer, avg(value) * any_value(coalesce(scale, 1)) + any_value(coalesce(off, 0)) AS mean, stddev_pop(value) * abs(any_value(coalesce(scale, 1))) AS std FROM pix JOIN lay ON zone = layer GROUP BY zone", "layer", "mean std")
add("p7_mask_values", lambda s, d: O.mask_values(pixels(s, d).withColumn("clamped", COL("value")), ["value"], low=-0.1, high=0.1).join(O.mask_values(pixels(s, d).withColumnRenamed("value", "clamped"), ["clamped"], low=-0.1, high=0.1, mode="clamp").select("row", "col", COL("clamped").alias("c")), ["row", "col"]), f"{PIXELS}\n--\nSELECT row, col, CASE WHEN value BETWEEN -0.1 AND 0.1 THEN value END AS value, greatest(least(value, 0.1), -0.1) AS c FROM pix", "row col", "value c")
add("u5_mosaic", lambda s, d: R.mosaic(pixels(s, d).withColumn("tile", COL("row")).withColumn("row", COL("row") % 50), "tile", (5, 40, 2, 60)), f"{PIXELS}\n--\nSELECT row % 50 AS row, col, max_by(value, row) AS value FROM pix WHERE row % 50 >= 5 AND row % 50 < 40 AND col >= 2 AND col < 60 GROUP BY ALL", "row col", "value")


def _z(dr: int, dc: int) -> str:
    at = lambda a, b: f"(SELECT row - ({a}) AS row, col - ({b}) AS col, value AS v FROM pix)"
    return at(dr, dc)


HORN = ", ".join(f"z{dr + 1}{dc + 1} AS {_z(dr, dc)}" for dr in (-1, 0, 1) for dc in (-1, 0, 1))
ZS = {(a, b): f"coalesce(z{a}{b}.v, 2 * z11.v - z{2 - a}{2 - b}.v, z11.v)" for a in range(3) for b in range(3) if 1 in (a, b)}
ZS |= {(a, b): f"coalesce(z{a}{b}.v, {ZS[a, 1]} + {ZS[1, b]} - z11.v)" for a in (0, 2) for b in (0, 2)}
add("w8_terrain", lambda s, d: R.terrain(pixels(s, d), []), f"""{PIXELS}, {HORN},
    g AS (SELECT row, col, ({ZS[0, 2]} + 2 * {ZS[1, 2]} + {ZS[2, 2]} - {ZS[0, 0]} - 2 * {ZS[1, 0]} - {ZS[2, 0]}) / 8 AS dx, ({ZS[2, 0]} + 2 * {ZS[2, 1]} + {ZS[2, 2]} - {ZS[0, 0]} - 2 * {ZS[0, 1]} - {ZS[0, 2]}) / 8 AS dy
        FROM z11 {" ".join(f"LEFT JOIN z{a}{b} USING (row, col)" for a in range(3) for b in range(3) if (a, b) != (1, 1))})
--
SELECT row, col, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope, (degrees(atan2(-dx, dy)) + 360) % 360 AS aspect FROM g""", "row col", "slope aspect", 5)
add("m8_soil_properties", lambda s, d: R.soil_properties(pixels(s, d).withColumns({"sand": F.abs("value") * 1000, "clay": F.abs("value") * 500})), f"{PIXELS}\n--\nSELECT row, col, (50.5 - 0.142 * (abs(value) * 100) - 0.037 * (abs(value) * 50)) / 100 AS porosity, 2.54 * power(10, -0.6 + 0.0126 * (abs(value) * 100) - 0.0064 * (abs(value) * 50)) AS conductivity FROM pix", "row col", "porosity conductivity")
add("m7_gridded_climate", lambda s, d: R.gridded_climate(pixels(s, d).groupBy("col", (COL("row") % 12 + 1).alias("month")).agg((F.avg(F.abs("value")) * 100).alias("p"), (F.avg(F.abs("value")) * 50).alias("pet"), (F.avg("value") * 1000).alias("t")), ["col"]), f"""{PIXELS}, m AS (SELECT col, row % 12 + 1 AS month, avg(abs(value)) * 100 AS p, avg(abs(value)) * 50 AS pet, avg(value) * 1000 AS t, 2 * pi() * (row % 12) / 12 AS x FROM pix GROUP BY ALL),
    a AS (SELECT col, CASE WHEN sum(p) = 0 THEN 1 ELSE sum(p) END AS sp, sum(pet) AS pet, sum(CASE WHEN t < 0 THEN p ELSE 0 END) AS snow, avg(p) AS m, 2 * avg(p * sin(x)) AS ps, 2 * avg(p * cos(x)) AS pc, 2 * avg(t * sin(x)) AS ts, 2 * avg(t * cos(x)) AS tc FROM m GROUP BY col)
--
SELECT col, pet / sp AS aridity, snow, snow / sp AS fsnow, (ps * ts + pc * tc) / (m * sqrt(ts * ts + tc * tc)) AS seasonality FROM a""", "col", "aridity snow fsnow seasonality")
add("t1_deviating_layers", lambda s, d: R.deviating_layers(table(s, d, "part").select((COL("p_partkey") % 20).alias("basin"), COL("p_partkey").alias("layer"), "p_brand", (COL("p_size") % 2).alias("kind")), "basin", ["p_brand", "kind"]), """l AS (SELECT p_partkey % 20 AS basin, p_partkey AS layer, p_brand, p_size % 2 AS kind FROM part), k AS (SELECT basin, p_brand, kind, count(*) AS n FROM l GROUP BY basin, p_brand, kind), c AS (SELECT *, row_number() OVER (PARTITION BY basin ORDER BY n DESC, p_brand, kind) AS r FROM k)
--
SELECT l.basin, layer FROM l WHERE NOT EXISTS (SELECT 1 FROM c WHERE r = 1 AND c.basin = l.basin AND c.p_brand = l.p_brand AND c.kind = l.kind)""", "basin layer")


def lakes(s, d):
    c = COL("s_suppkey")
    return table(s, d, "supplier").select((c % 30).alias("basin"), (c % 3).alias("type"), F.abs("s_acctbal").alias("area"), (F.abs("s_acctbal") / 7).alias("volume"))


add("a13_open_water", lambda s, d: R.open_water_stats(lakes(s, d), table(s, d, "customer").select((COL("c_custkey") % 40).alias("basin")), "basin"), """b AS (SELECT DISTINCT c_custkey % 40 AS basin FROM customer), l AS (SELECT s_suppkey % 30 AS basin, s_suppkey % 3 AS type, abs(s_acctbal) AS area, abs(s_acctbal) / 7 AS volume FROM supplier),
    g AS (SELECT basin, count(*) AS n_lakes, count(*) FILTER (type = 2) AS n_reservoirs, min(area) AS area_min, avg(area) AS area_mean, max(area) AS area_max, stddev_samp(area) AS area_std, sum(area) AS area_total, min(volume) AS volume_min, avg(volume) AS volume_mean, max(volume) AS volume_max, stddev_samp(volume) AS volume_std, sum(volume) AS volume_total FROM l GROUP BY basin)
--
SELECT basin, coalesce(n_lakes, 0) AS n_lakes, coalesce(n_reservoirs, 0) AS n_reservoirs, coalesce(area_min, 0) AS area_min, coalesce(area_mean, 0) AS area_mean, coalesce(area_max, 0) AS area_max, coalesce(area_std, 0) AS area_std, coalesce(area_total, 0) AS area_total, coalesce(volume_min, 0) AS volume_min, coalesce(volume_mean, 0) AS volume_mean, coalesce(volume_max, 0) AS volume_max, coalesce(volume_std, 0) AS volume_std, coalesce(volume_total, 0) AS volume_total FROM b LEFT JOIN g USING (basin)""", "basin n_lakes n_reservoirs", "area_min area_mean area_max area_std area_total volume_min volume_mean volume_max volume_std volume_total", 5)

# Forcing: lineitem parts as cells, days as times.
FORC = "forc AS (SELECT l_partkey AS cell, CAST(l_shipdate AS DATE) AS day, avg(l_extendedprice) / 137 AS t, sum(l_quantity) AS p FROM lineitem GROUP BY ALL)"
WEIGHTS = "wts AS (SELECT p_size % 10 AS hru, p_partkey AS cell, p_retailprice AS w FROM part)"


def forc(s, d):
    return table(s, d, "lineitem").groupBy(COL("l_partkey").alias("cell"), F.to_date("l_shipdate").alias("day")).agg((F.avg("l_extendedprice") / 137).alias("t"), F.sum("l_quantity").alias("p"))


def wts(s, d):
    return table(s, d, "part").select((COL("p_size") % 10).alias("hru"), COL("p_partkey").alias("cell"), COL("p_retailprice").alias("w"))


add("j4_remap", lambda s, d: O.remap(forc(s, d), wts(s, d), ["t", "p"], ["day"]), f"{FORC}, {WEIGHTS}\n--\nSELECT hru, day, sum(w * t) / sum(w) AS t, sum(w * p) / sum(w) AS p FROM forc JOIN wts USING (cell) GROUP BY ALL", "hru day", "t p")
add("j2_merge_vars", lambda s, d: O.merge_vars(forc(s, d).select("cell", "day", "t"), forc(s, d).where("p > 10").select("cell", "day", "p"), ["cell", "day"]), f"{FORC}\n--\nSELECT cell, day, t, p FROM forc WHERE p > 10", "cell day", "t p")
add("j2_missing_partners", lambda s, d: O.missing_partners(forc(s, d), forc(s, d).where("p > 10").select("cell", "day", "p"), ["cell", "day"]), f"{FORC}\n--\nSELECT cell, day, 'left' AS side FROM forc WHERE NOT p > 10", "cell day side")
CELLS = "cells AS (SELECT c_custkey AS cell, -140 + (c_custkey * 37 % 800) / 10.0 AS lon, 20 + (c_custkey * 53 % 500) / 10.0 AS lat FROM customer)"


def cells(s, d):
    c = COL("c_custkey")
    return table(s, d, "customer").select(c.alias("cell"), (-140 + (c * 37 % 800) / 10.0).alias("lon"), (20 + (c * 53 % 500) / 10.0).alias("lat"))


def boxes(s, d):
    """A rectangle of 1.5 by 1.55 degrees for each supplier: so many basins side by side, with some overlaps."""
    k = COL("s_suppkey")
    west, south = (-140 + k * 3 % 70).cast("double"), (20 + k * 7 % 40).cast("double")
    return table(s, d, "supplier").select(k.alias("nation"), west.alias("west"), south.alias("south"), (west + 1.5).alias("east"), (south + 1.55).alias("north"))


BOXES = "boxes AS (SELECT s_suppkey AS nation, CAST(-140 + s_suppkey * 3 % 70 AS DOUBLE) AS west, CAST(20 + s_suppkey * 7 % 40 AS DOUBLE) AS south, CAST(-140 + s_suppkey * 3 % 70 AS DOUBLE) + 1.5 AS east, CAST(20 + s_suppkey * 7 % 40 AS DOUBLE) + 1.55 AS north FROM supplier)"
add("j3_align_coords", lambda s, d: O.align_coords(cells(s, d).withColumns({"lon": COL("lon") + 1e-6, "lat": COL("lat") - 1e-6}), cells(s, d).where("cell % 3 = 0"), ["lon", "lat"]), f"{CELLS}, r AS (SELECT DISTINCT lon, lat FROM cells WHERE cell % 3 = 0)\n--\nSELECT cell, lon, lat FROM cells SEMI JOIN r USING (lon, lat)", "cell", "lon lat", 3)
add("j6_add_elevation", lambda s, d: O.add_elevation(cells(s, d), cells(s, d).where("cell % 2 = 0").groupBy("lon", "lat").agg(F.max("cell").cast("double").alias("z")), ["lon", "lat"]), f"{CELLS}, z AS (SELECT lon, lat, max(cell) AS z FROM cells WHERE cell % 2 = 0 GROUP BY ALL)\n--\nSELECT cell, z / 9.80665 AS elevation FROM cells LEFT JOIN z USING (lon, lat)", "cell", "elevation")
add("p10_snap_bbox", lambda s, d: O.snap_bbox(boxes(s, d).withColumns({c: COL(c) + 0.03 for c in ("west", "south", "east", "north")}), "ERA5"), f"{BOXES}\n--\nSELECT nation, floor((west + 0.03 - 0.125) / 0.25) * 0.25 AS west, floor((south + 0.03 - 0.125) / 0.25) * 0.25 AS south, ceil((east + 0.03 + 0.125) / 0.25) * 0.25 AS east, ceil((north + 0.03 + 0.125) / 0.25) * 0.25 AS north FROM boxes", "nation", "west south east north")
add("p10_bbox_filter", lambda s, d: O.bbox_filter(cells(s, d), boxes(s, d), "nation"), f"{CELLS}, {BOXES}\n--\nSELECT nation, cell, lon, lat FROM cells JOIN boxes ON lon BETWEEN west AND east AND lat BETWEEN south AND north", "nation cell", "lon lat")
add("p10_wrap_longitude", lambda s, d: O.wrap_longitude(cells(s, d).withColumn("lon", COL("lon") + 300), "lon"), f"{CELLS}\n--\nSELECT cell, CASE WHEN lon + 300 > 180 THEN lon - 60 ELSE lon + 300 END AS lon FROM cells", "cell", "lon")
add("p5_convert_units", lambda s, d: O.convert_units(rain(s, d).select("site", "day", COL("t").alias("tmean"), COL("p").alias("prcp")), O.RULES["EM-Earth"]), f"{RAIN}\n--\nSELECT site, day, t + 273.15 AS tmean, p / 3600 AS prcp FROM rain", "site day", "tmean prcp", 9)
add("p5_flow_units", lambda s, d: flow(s, d).select("site", "day", S.cubic_metres(COL("q")).alias("m3s"), S.flow_depth(S.cubic_metres(COL("q")), 1.0 + COL("site")).alias("mm")), f"{FLOW}\n--\nSELECT site, day, q * 0.0283168466 AS m3s, q * 0.0283168466 * 86400 / ((1 + site) * 1e6) * 1000 AS mm FROM flow", "site day", "m3s mm", 7)
add("p5_flux_units", lambda s, d: rain(s, d).select("site", "day", *[S.flux_depth(COL("p") / 1e5, S.seconds_in(k, COL("day"))).alias(k) for k in ("hour", "month", "year")], S.flux_depth(COL("p") / 1e5, S.seconds_in("day", COL("day"))).alias("daily")), f"{RAIN}\n--\nSELECT site, day, p / 1e5 * 3600 AS hour, p / 1e5 * 86400 AS daily, p / 1e5 * 86400 * day(last_day(day)) AS month, p / 1e5 * 86400 * 365.25 AS year FROM rain", "site day", "hour daily month year", 6)
add("p5_daymet_units", lambda s, d: O.convert_units(rain(s, d).select("site", "day", COL("t").alias("srad")), O.RULES["Daymet"]), f"{RAIN}\n--\nSELECT site, day, t * 1000 / 86400 AS srad FROM rain", "site day", "srad", 6)
add("p17_month_periods", lambda s, d: O.month_periods(table(s, d, "orders").groupBy((COL("o_custkey") % 50).alias("site")).agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("z")), "a", "z"), """r AS (SELECT o_custkey % 50 AS site, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders GROUP BY ALL), m AS (SELECT site, a, z, CAST(unnest(generate_series(date_trunc('month', a)::TIMESTAMP, date_trunc('month', z)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS m FROM r)
--
SELECT site, greatest(m, a) AS month_start, least(last_day(m), z) AS month_end FROM m""", "site month_start month_end")


def _checked(s, d):
    rows = rain(s, d).select("site", F.col("day").cast("timestamp").alias("ts"), F.when(COL("p") > 2, COL("p")).alias("p"), "t")
    return O.check_forcing(rows, ["site"], "ts", ["p", "t"], 86400)


CHECKED = f"""{RAIN}, g AS (SELECT site, day, CASE WHEN p > 2 THEN p END AS p, t, epoch(day) - lag(epoch(day)) OVER (PARTITION BY site ORDER BY day) <> 86400 AS gap FROM rain), a AS (SELECT site, avg(CAST(p IS NULL AS INTEGER)) AS np, avg(CAST(t IS NULL AS INTEGER)) AS nt, count(p) AS cp, count(t) AS ct, bool_or(gap) AS gap FROM g GROUP BY site), r AS (SELECT site, 'nulls in p' AS reason FROM a WHERE np >= 0.0001 UNION ALL SELECT site, 'nulls in t' FROM a WHERE nt >= 0.0001 UNION ALL SELECT site, 'no data in p' FROM a WHERE cp = 0 UNION ALL SELECT site, 'no data in t' FROM a WHERE ct = 0 UNION ALL SELECT site, 'time steps' FROM a WHERE gap UNION ALL SELECT site, 'starts at midnight' FROM a)"""
add("a28_check_forcing", _checked, f"{CHECKED}\n--\nSELECT * FROM r", "site reason")
add("a28_unequal_periods", lambda s, d: O.unequal_periods(table(s, d, "orders").select((COL("o_custkey") % 100).alias("basin"), (COL("o_orderkey") % 2).alias("part"), F.to_date("o_orderdate").alias("ts")), "basin", "part", "ts"), "a AS (SELECT o_custkey % 100 AS basin, o_orderkey % 2 AS part, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z, count(DISTINCT CAST(o_orderdate AS DATE)) AS n FROM orders GROUP BY ALL)\n--\nSELECT basin, 'periods differ' AS reason FROM a GROUP BY basin HAVING count(DISTINCT (a, z, n)) > 1", "basin reason")
add("a29_reason_counts", lambda s, d: O.reason_counts(_checked(s, d), "site"), f"{CHECKED}\n--\nSELECT reason, count(*) AS n, count(DISTINCT site) AS n_basins FROM r GROUP BY reason", "reason n n_basins")


def _compared(s, d):
    new = rain(s, d).where("dayofmonth(day) <> 7").withColumn("t", F.when(F.dayofmonth("day") == 9, COL("t") * 1.02).otherwise(COL("t")))
    return O.compare_series(rain(s, d), new, ["site"], "day", "t")


add("j13_compare_series", _compared, f"""{RAIN}, b AS (SELECT site, day, t AS a, CASE WHEN day(day) = 9 THEN t * 1.02 WHEN day(day) <> 7 THEN t END AS b FROM rain), x AS (SELECT *, abs(b - a) AS d FROM b)
--
SELECT site, count(b) AS n_common, count(*) - count(b) AS n_missing, CAST(0 AS BIGINT) AS n_added, count(*) FILTER (d > 0.1) AS n_absolute, count(*) FILTER (d > abs(a) * 0.01) AS n_relative, avg(d) FILTER (d > 0.1) AS mean_over, max(d) FILTER (d > 0.1) AS max_over, quantile_cont(d, 0.95) FILTER (d > 0.1) AS p95_over, avg(b) / avg(a) FILTER (b IS NOT NULL) AS mean_ratio, stddev_pop(b) / stddev_pop(a) FILTER (b IS NOT NULL) AS std_ratio, corr(b, a) AS correlation FROM x GROUP BY site""", "site n_common n_missing n_added n_absolute n_relative", "mean_over max_over p95_over mean_ratio std_ratio correlation")

# Geometry: points of customers, rectangles of nations.
RING = lambda x0, y0, x1, y1: F.array(*[F.struct(F.lit(0).alias("ring"), x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])


def polys(s, d):
    return boxes(s, d).select(COL("nation").alias("poly_id"), RING(COL("west"), COL("south"), COL("east"), COL("north")).alias("geometry"))


def grid(s, d):
    """Whole-degree cells under the customers' points."""
    return cells(s, d).select(F.floor("lon").alias("i"), F.floor("lat").alias("j")).distinct().select((COL("i") * 1000 + COL("j")).alias("cell"), (COL("i") + 0.5).cast("double").alias("x"), (COL("j") + 0.5).cast("double").alias("y"))


GRID = "grid AS (SELECT DISTINCT CAST(floor(lon) AS BIGINT) AS i, CAST(floor(lat) AS BIGINT) AS j FROM cells)"
CUT = f"{CELLS}, {BOXES}, {GRID}, cut AS (SELECT nation, i * 1000 + j AS cell, (least(east, i + 1) - greatest(west, i)) * (least(north, j + 1) - greatest(south, j)) AS area FROM boxes JOIN grid ON west < i + 1 AND east > i AND south < j + 1 AND north > j)"
add("j7_point_in_polygon", lambda s, d: X.point_in_polygon(cells(s, d).select(COL("cell").alias("id"), (COL("lon") + 0.013).alias("x"), (COL("lat") + 0.017).alias("y")), polys(s, d)), f"{CELLS}, {BOXES}\n--\nSELECT cell AS id, nation AS poly_id FROM cells JOIN boxes ON lon + 0.013 BETWEEN west AND east AND lat + 0.017 BETWEEN south AND north", "id poly_id")
add("j5_make_weights", lambda s, d: X.make_weights(grid(s, d), polys(s, d), 0.5), f"{CUT}\n--\nSELECT nation AS hru, cell, area / sum(area) OVER (PARTITION BY nation) AS weight FROM cut", "hru cell", "weight")


def grid_boxes(s, d):
    g = grid(s, d)
    return g.select(COL("cell").alias("box_id"), (COL("x") - 0.5).alias("rx0"), (COL("y") - 0.5).alias("ry0"), (COL("x") + 0.5).alias("rx1"), (COL("y") + 0.5).alias("ry1"))


add("j11_clip_layer", lambda s, d: X.clip_layer(polys(s, d), grid_boxes(s, d)), f"{CUT}\n--\nSELECT nation AS poly_id, cell AS box_id, area FROM cut", "poly_id box_id", "area")
add("a34_dissolve", lambda s, d: X.dissolve(X.clip_layer(polys(s, d), grid_boxes(s, d)), "poly_id"), f"{CUT}\n--\nSELECT nation AS poly_id, sum(area) AS area, count(*) AS n_parts FROM cut GROUP BY nation", "poly_id n_parts", "area")


def moved(s, d):
    """Another rectangle for each supplier, an hour of longitude to the east."""
    return boxes(s, d).select(COL("nation").alias("poly_id"), RING(COL("west") + 1, COL("south"), COL("east") + 1, COL("north")).alias("geometry"))


def basins(s, d):
    return moved(s, d).where("poly_id % 3 = 1").withColumnRenamed("poly_id", "basin_id")


SHARED = f"{BOXES}, shr AS (SELECT a.nation AS poly_id, b.nation AS basin_id, (least(a.east, b.east + 1) - greatest(a.west, b.west + 1)) * (least(a.north, b.north) - greatest(a.south, b.south)) AS area, (a.east - a.west) * (a.north - a.south) AS whole FROM boxes a JOIN boxes b ON b.nation % 3 = 1 AND a.west < b.east + 1 AND a.east > b.west + 1 AND a.south < b.north AND a.north > b.south)"
add("j11_overlaps", lambda s, d: X.overlaps(polys(s, d), basins(s, d), 2.0), f"{SHARED}\n--\nSELECT poly_id, basin_id, area FROM shr", "poly_id basin_id", "area")
add("j11_intersecting", lambda s, d: X.intersecting(polys(s, d), basins(s, d), 2.0).groupBy("basin_id").agg(F.count("*").alias("n"), F.sum(F.size("geometry")).alias("corners")), f"{SHARED}\n--\nSELECT basin_id, count(*) AS n, 4 * count(*) AS corners FROM shr GROUP BY basin_id", "basin_id n corners")
add("j11_clip_lakes", lambda s, d: X.clip_lakes(boxes(s, d).select(COL("nation").alias("poly_id"), ((COL("east") - COL("west")) * (COL("north") - COL("south"))).alias("area"), (COL("nation") * 1.5).cast("double").alias("volume")), X.overlaps(polys(s, d), basins(s, d), 2.0)), f"{SHARED}\n--\nSELECT poly_id, basin_id, round(round(area, 9), 2) AS area, poly_id * 1.5 * round(round(area, 9), 2) / whole AS volume FROM shr", "poly_id basin_id", "area volume", 5)
add("j12_overlap_fraction", lambda s, d: X.overlap_fraction(polys(s, d), moved(s, d), 2.0), f"{BOXES}\n--\nSELECT nation AS poly_id, (east - west - 1) / (east - west) AS fraction FROM boxes", "poly_id", "fraction")
add("j14_assign_zones", lambda s, d: X.assign_zones(grid(s, d).withColumnRenamed("cell", "pixel"), polys(s, d), 0.5, 0.5), f"{CUT}\n--\nSELECT cell AS pixel, nation AS zone FROM cut", "pixel zone")
add("j14_assign_zones_centres", lambda s, d: X.assign_zones(grid(s, d).withColumnRenamed("cell", "pixel"), polys(s, d), 0.5, 0.5, all_touched=False), f"{CELLS}, {BOXES}, {GRID}\n--\nSELECT i * 1000 + j AS pixel, nation AS zone FROM grid JOIN boxes ON i + 0.5 >= west AND i + 0.5 < east AND j + 0.5 >= south AND j + 0.5 < north", "pixel zone")
add("j14_crop_window", lambda s, d: X.crop_window(polys(s, d), "poly_id", 0.3, 0.4), f"{BOXES}\n--\nSELECT nation AS poly_id, west - 0.5 AS west, south - 0.5 AS south, east + 0.5 AS east, north + 0.5 AS north FROM boxes", "poly_id", "west south east north")
add("a34_first_segments", lambda s, d: X.first_of(table(s, d, "orders").select(COL("o_custkey").alias("comid"), "o_orderkey", "o_totalprice"), "comid", "o_orderkey"), "SELECT o_custkey AS comid, min(o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey", "comid o_orderkey", "o_totalprice", 2)


def _snapped(s, d):
    line = F.array(*[F.struct(F.lit(0).alias("ring"), x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in ((COL("west"), COL("south")), (COL("east"), COL("south")), (COL("east"), COL("north")))])
    lines = boxes(s, d).where("nation % 5 <> 0").select("nation", line.alias("geometry"))
    return X.snap_to_line(cells(s, d).select(COL("cell").alias("id"), COL("lon").alias("x"), COL("lat").alias("y"), (COL("cell") % 100).cast("long").alias("nation")), lines, "nation")


add("j8_snap_to_line", _snapped, f"""{CELLS}, {BOXES}, p AS (SELECT cell AS id, lon AS x, lat AS y, boxes.* FROM cells LEFT JOIN boxes ON cell % 100 = nation AND nation % 5 <> 0),
    c AS (SELECT id, greatest(least(x, east), west) AS px, south AS py, x, y FROM p WHERE nation IS NOT NULL UNION ALL SELECT id, east, greatest(least(y, north), south), x, y FROM p WHERE nation IS NOT NULL),
    e AS (SELECT id, px, py, sqrt((px - x) * (px - x) + (py - y) * (py - y)) AS d FROM c), b AS (SELECT id, min_by({{'px': px, 'py': py, 'd': d}}, {{'d': d, 'x': px, 'y': py}}) AS b FROM e GROUP BY id)
--
SELECT p.id, b.px AS x, b.py AS y, b.d AS distance FROM p LEFT JOIN b ON p.id = b.id""", "id", "x y distance")


def albers_sql(lon: str, lat: str) -> tuple[str, str]:
    import math

    e2 = 0.00669438002290
    e = math.sqrt(e2)
    q = lambda x: (1 - e2) * (x / (1 - e2 * x * x) - 1 / (2 * e) * math.log((1 - e * x) / (1 + e * x)))
    m = lambda p: math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)
    p1, p2, p0 = (math.radians(v) for v in (20, 60, 40))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(math.sin(p2)) - q(math.sin(p1)))
    c = m(p1) ** 2 + n * q(math.sin(p1))
    sn = f"sin(radians({lat}))"
    rho = f"({6378137.0 / n!r} * sqrt({c!r} - {n!r} * ({1 - e2!r} * ({sn} / (1 - {e2!r} * {sn} * {sn}) - {1 / (2 * e)!r} * ln((1 - {e!r} * {sn}) / (1 + {e!r} * {sn}))))))"
    th = f"({n!r} * radians({lon} + 96))"
    return f"({rho} * sin({th}) / 1000)", f"(({6378137.0 / n * math.sqrt(c - n * q(math.sin(p0)))!r} - {rho} * cos({th})) / 1000)"


_AX, _AY = albers_sql("x", "y")
VERTS = f"{BOXES}, v AS (SELECT nation, i, CASE WHEN i IN (0, 3) THEN west ELSE east END AS x, CASE WHEN i < 2 THEN south ELSE north END AS y FROM boxes, unnest(range(0, 4)) AS u(i)), a AS (SELECT nation, i, {_AX} AS x, {_AY} AS y FROM v)"
add("a33_poly_area", lambda s, d: X.drop_tiny(X.poly_area(polys(s, d), "poly_id")), f"{VERTS}, n AS (SELECT a.*, b.x AS x2, b.y AS y2 FROM a JOIN a b ON a.nation = b.nation AND b.i = (a.i + 1) % 4)\n--\nSELECT nation AS poly_id, abs(sum(x * y2 - x2 * y) / 2) AS area_km2, sum((x + x2) * (x * y2 - x2 * y)) / (3 * sum(x * y2 - x2 * y)) AS cx, sum((y + y2) * (x * y2 - x2 * y)) / (3 * sum(x * y2 - x2 * y)) AS cy FROM n GROUP BY nation", "poly_id", "area_km2 cx cy", 3)
add("a33_line_length", lambda s, d: X.line_length(polys(s, d), "poly_id"), f"{VERTS}\n--\nSELECT a.nation AS poly_id, sum(sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y))) AS length_km FROM a JOIN a b ON a.nation = b.nation AND b.i = a.i + 1 GROUP BY a.nation", "poly_id", "length_km", 4)

# River network of customers: comid flows into comid div 2.
UPSQL = "up AS (SELECT comid, comid AS member FROM net UNION ALL SELECT up.comid, net.comid FROM up JOIN net ON net.next_down = up.member)"
add("g1_stream_lengths", lambda s, d: N.stream_lengths(net(s, d)), f"RECURSIVE {NET}, w AS (SELECT comid AS head, next_down AS at, length AS len FROM net WHERE comid NOT IN (SELECT next_down FROM net) UNION ALL SELECT head, net.next_down, len + length FROM w JOIN net ON net.comid = w.at)\n--\nSELECT CAST(0 AS INTEGER) AS basin, head AS comid, max(len) AS stream_length FROM w GROUP BY head", "basin comid", "stream_length")
add("g2_upstream_area", lambda s, d: N.upstream_area(net(s, d), net(s, d).select("basin", "comid")), f"RECURSIVE {NET}, {UPSQL}\n--\nSELECT CAST(0 AS INTEGER) AS basin, up.comid, count(*) AS n_up, sum(unitarea) AS area FROM up JOIN net ON net.comid = up.member GROUP BY up.comid", "basin comid n_up", "area")
add("g3_find_outlets", lambda s, d: N.find_outlets(net(s, d).where("comid % 7 <> 0")), f"{NET}, k AS (SELECT * FROM net WHERE comid % 7 <> 0)\n--\nSELECT CAST(0 AS INTEGER) AS basin, comid, next_down FROM k WHERE next_down NOT IN (SELECT comid FROM k)", "basin comid next_down")


def split_net(s, d):
    """Every segment divisible by 9 was split: its number is now n.1."""
    n = net(s, d).withColumn("up1", F.floor("next_down") * 3)
    c = F.when(COL("comid") % 9 == 0, COL("comid") + F.lit(0.1).cast("decimal(3,2)")).otherwise(COL("comid")).cast("decimal(12,2)")
    return n.select("basin", c.alias("comid"), COL("next_down").cast("decimal(12,2)").alias("next_down"), COL("up1").cast("decimal(12,2)").alias("up1"))


FIX = "CASE WHEN {c} % 9 = 0 AND {c} IN (SELECT comid FROM net) THEN {c} + 0.1 ELSE {c} END"
add("g4_repair_links", lambda s, d: N.repair_links(split_net(s, d))[0], f"{NET}\n--\nSELECT CAST(0 AS INTEGER) AS basin, CASE WHEN comid % 9 = 0 THEN comid + 0.1 ELSE comid END AS comid, {FIX.format(c='next_down')} AS next_down, {FIX.format(c='next_down * 3')} AS up1 FROM net", "basin", "comid next_down up1", 2)
add("g4_change_log", lambda s, d: N.repair_links(split_net(s, d))[1], f"{NET}, x AS (SELECT comid, 'next_down' AS link, next_down AS old FROM net UNION ALL SELECT comid, 'up1', next_down * 3 FROM net)\n--\nSELECT link, CASE WHEN comid % 9 = 0 THEN comid + 0.1 ELSE comid END AS comid, old, old + 0.1 AS new FROM x WHERE old % 9 = 0 AND old IN (SELECT comid FROM net)", "link", "comid old new", 2)
add("g5_add_missing", lambda s, d: N.add_missing_segments(net(s, d).where("comid % 11 <> 0"), net(s, d)), f"""RECURSIVE {NET}, k AS (SELECT * FROM net WHERE comid % 11 <> 0), up AS (SELECT comid, comid AS member FROM k UNION ALL SELECT up.comid, k.comid FROM up JOIN k ON k.next_down = up.member), ar AS (SELECT up.comid, sum(unitarea) AS area FROM up JOIN k ON k.comid = up.member GROUP BY up.comid)
--
SELECT CAST(0 AS INTEGER) AS basin, k.comid, 0 AS added, unitarea, area AS uparea FROM k JOIN ar ON k.comid = ar.comid UNION ALL
SELECT 0, n.comid, 1, n.unitarea, n.unitarea + coalesce((SELECT sum(area) FROM ar JOIN k ON k.comid = ar.comid WHERE k.next_down = n.comid), 0) FROM net n WHERE n.comid % 11 = 0""", "basin comid added", "unitarea uparea")


def river(s, d):
    return net(s, d).withColumns({"order": COL("ord"), "slope": COL("unitarea") / 100, "uparea": COL("unitarea") * 3})


add("a31_river_attributes", lambda s, d: N.river_attributes(river(s, d), net(s, d).groupBy("basin").agg(F.sum("unitarea").alias("area"))), f"""RECURSIVE {NET}, w AS (SELECT comid AS head, next_down AS at, length AS len FROM net WHERE comid NOT IN (SELECT next_down FROM net) UNION ALL SELECT head, net.next_down, len + length FROM w JOIN net ON net.comid = w.at),
    h AS (SELECT head, max(len) AS s FROM w GROUP BY head), x AS (SELECT min(s) AS stream_min, avg(s) AS stream_mean, max(s) AS stream_max, stddev_pop(s) AS stream_std FROM h), b AS (SELECT sum(unitarea) AS area, sum(length) AS length, max(ord) AS max_order FROM net)
--
SELECT CAST(0 AS INTEGER) AS basin, max_order, length, stream_min, stream_mean, stream_max, stream_std, length / area AS density, 2 * sqrt(area / pi()) / stream_max AS elongation FROM b, x""", "basin max_order", "length stream_min stream_mean stream_max stream_std density elongation", 5)
add("a32_subbasin_river", lambda s, d: N.subbasin_river_attributes(river(s, d).where("comid % 4 <> 0"), net(s, d).select("basin", "comid", COL("unitarea").alias("area"))), f"{NET}\n--\nSELECT CAST(0 AS INTEGER) AS basin, comid, unitarea AS area, CASE WHEN comid % 4 <> 0 THEN length END AS length, CASE WHEN comid % 4 <> 0 THEN unitarea / 100 END AS slope, CASE WHEN comid % 4 <> 0 THEN unitarea * 3 END AS uparea, CASE WHEN comid % 4 <> 0 THEN length / unitarea END AS density, CASE WHEN comid % 4 <> 0 THEN 2 * sqrt(unitarea / pi()) / nullif(length, 0) END AS elongation FROM net", "basin comid", "area length slope uparea density elongation")
