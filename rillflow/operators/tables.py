"""Metadata, attribute and flow tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.legends import FLAGS
from rillflow.functions.scalars import cubic_metres, mapped
from rillflow.operators.shared import in_order, written


def drop_unusable(df: DataFrame, unusable: DataFrame, missing: str | None = None) -> DataFrame:
    """Rows whose (country, station) isn't listed as unusable, for one kind of missing data or any."""
    bad = unusable.where(F.col("missing") == missing) if missing else unusable
    return df.join(bad.select("country", "station").distinct(), ["country", "station"], "left_anti")


def subset_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def select_subbasins(basins: DataFrame, rivers: DataFrame, outlets: DataFrame) -> DataFrame:
    """Sub-basins of a river's segments; a basin without any takes the one that its outlet point fell in."""
    by_river = basins.join(rivers.select("basin", "comid").distinct(), ["basin", "comid"], "left_semi")
    rest = outlets.join(by_river.select("basin").distinct(), "basin", "left_anti").select("basin", "comid")
    return by_river.unionByName(basins.join(rest, ["basin", "comid"], "left_semi"))


def record_period(meta: DataFrame, unusable: DataFrame, keys: list[str]) -> DataFrame:
    """Record period in whole days from the iv and dv availability: both kinds usable: earliest start and latest end;
    one: its own; none: no row. Text that isn't a time counts as absent."""
    bad = unusable.groupBy(*keys).agg(*[F.max((F.col("missing") == k).cast("int")).alias(f"_{k}") for k in ("iv", "dv")])
    rows = meta.join(bad, keys, "left")
    at = lambda k, end: F.when(F.coalesce(F.col(f"_{k}"), F.lit(0)) == 0, F.to_date(F.try_to_timestamp(f"{k}_{end}")))
    rows = rows.withColumns({"start": F.least(at("iv", "start"), at("dv", "start")), "end": F.greatest(at("iv", "end"), at("dv", "end"))})
    return rows.where("start is not null and end is not null").select(*keys, "start", "end")


def normalise_wsc_codes(df: DataFrame, grades=(-1, 10, 20, 30, 40, 50, 100)) -> DataFrame:
    """Unknown grades become 0, Checked and Ready for Approval become Reviewed, Undefined becomes nan."""
    a = F.col("approval")
    return df.withColumns({"grade": F.when(F.col("grade").isin(*grades), F.col("grade")).otherwise(0), "approval": F.when(a.isin("Checked", "Ready for Approval"), "Reviewed").when(a == "Undefined", "nan").otherwise(a)})


def count_replaced(before: DataFrame, after: DataFrame, keys: list[str], col: str) -> DataFrame:
    both = before.select(*keys, F.col(col).alias("a")).join(after.select(*keys, F.col(col).alias("b")), keys)
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).groupBy(F.col("a").cast("string").alias("old"), F.col("b").cast("string").alias("new")).agg(F.count("*").alias("n"))


def filter_dates(df: DataFrame, day: str, last_years: int | None = None, last_months: int | None = None, last_days: int | None = None, year: list[int] | None = None, month: list[int] | None = None, dom: list[int] | None = None) -> DataFrame:
    """Layers from so many years, months or days (one of the three) before the newest one on, that day included, and of
    the listed years, months and days."""
    if sum(bool(n) for n in (last_years, last_months, last_days)) > 1:
        raise ValueError("only one of last_years, last_months and last_days")
    rows, newest = df, df.agg(F.max(day)).scalar()
    if last_years or last_months:
        rows = rows.where(F.col(day) >= F.add_months(newest, -(12 * (last_years or 0) + (last_months or 0))))
    elif last_days:
        rows = rows.where(F.col(day) >= F.date_sub(newest, last_days))
    for f, some in ((F.year, year), (F.month, month), (F.dayofmonth, dom)):
        rows = rows.where(f(day).isin(*some)) if some else rows
    return rows


def subset_category(meta: DataFrame, key: str, area: str, n_sub: str) -> DataFrame:
    """headwater (one sub-basin), meso (up to 1000 km2), macro (up to 10000 km2), excluded."""
    c = F.when(F.col(n_sub) == 1, "headwater").when(F.col(area) <= 1e3, "meso").when(F.col(area) <= 1e4, "macro").otherwise("excluded")
    return meta.select(key, c.alias("category"))


def best_coords(meta: DataFrame, names=("manual", "mapped", "outlet", "station"), sentinel: float = -999.0) -> DataFrame:
    """lat and lon from the first source that has both."""
    ok = lambda n: (F.col(f"{n}_lat") != sentinel) & (F.col(f"{n}_lon") != sentinel)
    pick = lambda c: F.coalesce(*[F.when(ok(n), F.col(f"{n}_{c}")) for n in names])
    return meta.withColumns({"lat": pick("lat"), "lon": pick("lon"), "origin": F.coalesce(*[F.when(ok(n), F.lit(n)) for n in names])})


def harmonise_stations(can: DataFrame, usa: DataFrame) -> DataFrame:
    """One schema for both national tables: country, station (zero-padded to 8 for the USA), name, area in km2."""
    a = can.select(F.lit("CAN").alias("country"), F.col("station").cast("string").alias("station"), "name", F.col("area_km2").cast("double").alias("area_km2"))
    b = usa.select(F.lit("USA").alias("country"), F.lpad(F.col("station").cast("string"), 8, "0").alias("station"), "name", (F.col("area_m2") / 1e6).alias("area_km2"))
    return a.unionByName(b)


def correct_units(attributes: DataFrame, fixes: dict[str, str], monthly: dict[str, str] | None = None) -> DataFrame:
    """Unit by attribute name, and by the name without its month (name_01 .. name_12)."""
    stem = F.regexp_replace("attribute", "_(0[1-9]|1[0-2])$", "")
    found = [mapped(F.col("attribute"), fixes)] + ([F.when(stem != F.col("attribute"), mapped(stem, monthly))] if monthly else [])
    return attributes.withColumn("unit", F.coalesce(*found, F.col("unit")))


def write_attributes(attributes: DataFrame, basins: list[str]) -> DataFrame:
    """Long rows to one wide row per (category, attribute, unit, source) with a column per listed basin."""
    return attributes.groupBy("category", "attribute", "unit", "source").pivot("basin", basins).agg(F.first("value"))


def unpivot_attributes(wide: DataFrame, ids: list[str], values: list[str]) -> DataFrame:
    return wide.unpivot(ids, values, "attribute", "value").where("value is not null")


def hydat_to_daily(months: DataFrame) -> DataFrame:
    """Wide months (station, year, month, n_days, flow1.., symbol1..) to daily rows: only days that the month has."""
    pairs = F.array(*[F.struct(F.col(f"flow{i}").cast("double").alias("flow"), F.col(f"symbol{i}").cast("string").alias("symbol")) for i in range(1, 32)])
    rows = months.select("station", "year", "month", "n_days", F.posexplode(pairs).alias("i", "x")).where("i < n_days")
    return rows.select("station", F.make_date("year", "month", F.col("i") + 1).alias("day"), "x.flow", "x.symbol")


def stack_tables(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def id_differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of only one side."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def merge_blocks(blocks: list[DataFrame], key: str) -> DataFrame:
    """Attribute blocks of the same units, stacked; fails if a block's ids differ from the first one's."""
    for other in blocks[1:]:
        if not id_differences(blocks[0], other, [key]).isEmpty():
            raise ValueError(f"blocks differ in {key}")
    return stack_tables(*blocks)


def upsert_series(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Series of stations in new replace the old ones."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def common_times(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def availability(meta: DataFrame, key: str, start: str, end: str, missing: str) -> DataFrame:
    """duration in days, missing share, net years, and the share of stations with no more net years."""
    d = F.datediff(end, start) + 1
    rows = meta.select(key, d.alias("duration"), (F.col(missing) / d).alias("missing_share"), ((d - F.col(missing)) / 365.25).alias("net_years"))
    counts = rows.groupBy("net_years").agg(F.count("*").alias("_c"))
    upto = in_order(counts, ["net_years"], "_i", {"_upto": F.col("_c")})
    whole = rows.agg(F.count("*")).scalar()
    return rows.join(upto.select(F.col("net_years").alias("_y"), "_upto"), F.col("net_years").eqNullSafe(F.col("_y"))).withColumn("cdf", F.col("_upto") / whole).drop("_y", "_upto")


def availability_counts(av: DataFrame, shares: tuple[float, ...] = (0.01, 0.1), years: tuple[float, ...] = (10.0, 20.0)) -> DataFrame:
    """measure, threshold, n: stations that miss nothing, that miss less than each share, and that have fewer net years."""
    under = [("missing_share", t, F.col("missing_share") < t) for t in shares] + [("net_years", t, F.col("net_years") < t) for t in years]
    rows = [("missing_share", 0.0, F.col("missing_share") == 0), *under]
    counts = av.agg(*[F.count_if(c).alias(f"c{i}") for i, (*_, c) in enumerate(rows)])
    made = F.array(*[F.struct(F.lit(k).alias("measure"), F.lit(float(t)).alias("threshold"), F.col(f"c{i}").alias("n")) for i, (k, t, _) in enumerate(rows)])
    return counts.select(F.inline(made))


def year_histogram(av: DataFrame, width: int = 5) -> DataFrame:
    return av.groupBy((F.floor(F.col("net_years") / width) * width).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def nested_ids(polys: DataFrame, basin: str, comid: str, area: str, tolerance: float = 1e-6) -> DataFrame:
    """Ids that occur in several basins, and whether their areas differ there."""
    per = polys.groupBy(comid).agg(F.count_distinct(basin).alias("n_basins"), (F.max(area) - F.min(area) > tolerance).alias("areas_differ"))
    return per.where("n_basins > 1")


def update_meta(meta: DataFrame, series: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """First and last time and number of missing values of each series, written back; metadata without one keeps its own."""
    per = series.groupBy(key).agg(F.min(ts).alias("_a"), F.max(ts).alias("_z"), F.count_if(F.col(value).isNull()).alias("_n"))
    rows = meta.join(per, key, "left")
    return rows.withColumns({"first": F.coalesce("_a", "first"), "last": F.coalesce("_z", "last"), "n_missing": F.coalesce("_n", "n_missing")}).drop("_a", "_z", "_n")


def size_tradeoff(sizes: DataFrame, key: str, area: str, size: str) -> DataFrame:
    """Basins by area with cumulative size and its second difference; cut is the last place where that changes sign.

    Rows are numbered in a global order without a window over all of them; neighbours meet by their numbers.
    """
    rows = written(in_order(sizes.select(key, area, F.col(size).alias("_size")), [area, key], "_i", {"cumulative": F.col("_size")}), "sizes")
    after = rows.select((F.col("_i") - 1).alias("_i"), F.col("_size").alias("_after"))
    # Sums differ by the sizes themselves: the second difference is the next size less this one.
    rows = rows.join(after, "_i", "left").withColumn("second", F.when(F.col("_i") > 0, F.col("_after") - F.col("_size")))
    last = rows.select((F.col("_i") + 1).alias("_i"), F.signum("second").alias("_sign"))
    rows = written(rows.join(last, "_i", "left").withColumn("_change", F.signum("second") * F.col("_sign") < 0), "size-changes")
    cut = rows.where("_change").agg(F.max(area)).scalar()
    return rows.withColumn("cut", cut).select(key, area, "cumulative", "second", "cut")


def area_thresholds(sizes: DataFrame, thresholds: list[float], area: str, size: str) -> DataFrame:
    """Number of basins and total size up to each area threshold."""
    t = F.explode(F.filter(F.array(*[F.lit(float(x)) for x in sorted(thresholds)]), lambda x: x >= F.col(area)))
    return sizes.withColumn("threshold", t).groupBy("threshold").agg(F.count("*").alias("n"), F.sum(size).alias("total"))


#: Flags that a country's product doesn't have.
WITHOUT = {"USA": ("is_below_sensor_level",), "CAN": ("is_malfunction_affected", "is_backwater_affected")}


def to_flow_product(hourly: DataFrame, keys: list[str], flags: dict[str, Column], country: str | None = None) -> DataFrame:
    """The published columns: q_obs, its quality and flags with the prefix q_obs_, and time bounds. For a country: without
    the flags that it doesn't have, and for the USA with ft3/s as m3/s."""
    kept = {k: c for k, c in flags.items() if k not in WITHOUT.get(country, ())}
    value = cubic_metres(F.col("value")) if country == "USA" else F.col("value")
    return hourly.select(*keys, "hour", (F.col("hour") + F.expr("INTERVAL 1 HOUR")).alias("bounds_end"), value.alias("q_obs"), F.col("quality").alias("q_obs_data_quality"), *[c.alias(f"q_obs_{k}") for k, c in kept.items()])


def flag_meanings(product: DataFrame, country: str) -> DataFrame:
    """q_obs_data_quality, meaning of the flags that a product holds; null for one that isn't known."""
    found = product.select("q_obs_data_quality").distinct()
    return found.withColumn("meaning", mapped(F.col("q_obs_data_quality"), FLAGS[country]))


def write_product(product: DataFrame, path: str, by: list[str]) -> None:
    """Parquet files by country, basin or the like; each of them in time order."""
    product.repartitionByRange(*by, "hour").sortWithinPartitions(*by, "hour").write.partitionBy(*by).parquet(path)


def write_wide(wide: DataFrame, path: str) -> None:
    """The wide attribute table as one CSV with a header: a few thousand rows, one per attribute."""
    wide.coalesce(1).write.option("header", True).csv(path)


def merge_periods(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Pieces of a basin's series together and in order, ready to be written: parts are ranges of (basin, time), so a
    long series is dealt over several, one after another."""
    return df.repartitionByRange(key, ts).sortWithinPartitions(key, ts)


def season_counts_top(df: DataFrame, keys: list[str], label: Column) -> DataFrame:
    """The most frequent label per key; of equally frequent ones the first by name."""
    counts = df.groupBy(*keys, label.alias("label")).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("label"), F.max("n").alias("n"))


def series_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def write_series(df: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Writes series by buckets of their key: one folder each, which `replace_series` can replace."""
    df.withColumn("bucket", series_bucket(key, buckets)).repartition("bucket").write.partitionBy("bucket").parquet(path)


def replace_series(path: str, new: DataFrame, key: str, buckets: int = 64) -> list[int]:
    """Series of the stations in new replace those written at path; the buckets that were written anew. Others aren't read
    or touched. What replaces a bucket is written aside first and then takes its place by rename; after a failure in
    between, the same call gives the same table."""
    spark = new.sparkSession
    rows = written(new.withColumn("bucket", series_bucket(key, buckets)), "new-series")
    touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())  # at most `buckets`
    old = spark.read.schema(rows.schema).parquet(path).where(F.col("bucket").isin(touched))
    kept = written(old.join(rows.select(key).distinct(), key, "left_anti").select(*rows.columns).unionByName(rows), "replaced-series")
    kept.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return touched
