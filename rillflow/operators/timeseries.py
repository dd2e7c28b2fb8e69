"""Time series per site: cleaning, resampling, gaps, runs and whole years.

Windows are partitioned by the site's keys and a block of time (`scan`), so a site of any length is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.scalars import season
from rillflow.operators import scan
from rillflow.operators.shared import written

# Status codes that gauges report in place of a flow.
STATUS_CODES = ("***", "Bkw", "Dis", "Eqp", "Ice", "Rat", "Ssn")
STATUS_FLAGS = {"ice": "Ice", "malfunction": "Eqp", "backwater": "Bkw"}
# Symbols of daily flows in Canada.
CAN_SYMBOLS = {"partial_day": "A", "ice_affected": "B", "dry_day": "D", "estimated_value": "E"}
# USGS quality codes from worst to best.
USGS_ORDER = ("nan", "A:[0]", "A:<", "A:>", "A:[4]", "P:[4]", "P:e", "P", "A:R", "A:e", "A", "A:[93]", "A:[92]", "A:[91]", "A:[90]")

# Canadian approval:grade codes from worst to best.
WSC_ORDER = (
    "Provisional/Provisoire:0", "Provisional/Provisoire:40", "Provisional/Provisoire:10", "Provisional/Provisoire:20", "Provisional/Provisoire:30", "Provisional/Provisoire:nan", "Provisional/Provisoire:-1", "Provisional/Provisoire:50",
    "Final/Finales:0", "Final/Finales:40", "Final/Finales:10", "Final/Finales:50", "Final/Finales:20", "Final/Finales:30", "Final/Finales:nan", "Final/Finales:-1",
    "nan:0", "nan:10", "nan:20", "nan:30", "nan:40", "nan:50", "nan:nan", "nan:-1",
    "Preliminary:0", "Preliminary:40", "Preliminary:10", "Preliminary:20", "Preliminary:30", "Preliminary:nan", "Preliminary:-1", "Preliminary:50",
    "Reviewed:0", "Reviewed:10", "Reviewed:20", "Reviewed:30", "Reviewed:40", "Reviewed:50", "Reviewed:nan", "Reviewed:-1",
    "Approved:0", "Approved:40", "Approved:10", "Approved:50", "Approved:20", "Approved:30", "Approved:nan", "Approved:-1",
)

#: Half an hour in microseconds.
HALF = 1_800_000_000

_UP = (Window.unboundedPreceding, Window.currentRow)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def clean_flow(df: DataFrame, value: str, codes=STATUS_CODES) -> DataFrame:
    """Status codes and text to null, negative flows to null; the column becomes double."""
    number = F.when(F.col(value).isin(*codes), None).otherwise(F.expr(f"try_cast(`{value}` AS DOUBLE)"))
    return df.withColumn(value, F.when(F.isnan(number) | (number < 0), None).otherwise(number))


def status_flags(df: DataFrame, value: str, flags: dict[str, str] = STATUS_FLAGS) -> DataFrame:
    """One 0/1 column is_<name> per code, case-insensitive."""
    return df.withColumns({f"is_{k}": F.coalesce((F.lower(value) == c.lower()).cast("int"), F.lit(0)) for k, c in flags.items()})


def dst_to_lst(df: DataFrame, keys: list[str], ts: str, zone: str) -> DataFrame:
    """Rows whose zone isn't the site's standard code (xST) are shifted by an hour back.

    A site with over two codes, or without a standard one, gets a null time.
    """
    per = df.groupBy(*keys).agg(F.count_distinct(zone).alias("_n"), F.max(F.when(F.col(zone).rlike("ST$"), F.col(zone))).alias("_std"))
    fixed = F.when((F.col("_n") > 2) | F.col("_std").isNull(), None).when(F.col(zone) == F.col("_std"), F.col(ts)).otherwise(F.col(ts) - F.expr("INTERVAL 1 HOUR"))
    return df.join(per, keys).withColumn(ts, fixed).drop("_n", "_std")


def utc_to_lst(df: DataFrame, ts: str, offset_hours: Column, whole_hours: bool = False) -> DataFrame:
    """UTC to local standard time; half hours are dropped for hourly data (Newfoundland takes Atlantic time)."""
    hours = F.floor(F.abs(offset_hours)) * F.signum(offset_hours) if whole_hours else offset_hours
    if whole_hours:
        hours = F.when(offset_hours == -3.5, F.lit(-4.0)).otherwise(hours)
    return df.withColumn(ts, F.timestamp_micros(micros(F.col(ts)) + (hours * 3600).cast("long") * 1_000_000))


def half_hour_marks(df: DataFrame, keys: list[str], ts: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): keys, _t (microseconds), _v, _obs of the observations and of every half hour between a site's first
    and last one; keys, _first, _last."""
    obs = df.select(*keys, micros(F.col(ts)).alias("_t"), F.col(value).cast("double").alias("_v"), F.lit(1).alias("_obs"))
    first, last = F.ceil(F.min("_t") / HALF).cast("long") * HALF, F.floor(F.max("_t") / HALF).cast("long") * HALF
    span = obs.groupBy(*keys).agg(first.alias("_a"), last.alias("_z"), F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    marks = span.where("_a <= _z").select(*keys, F.explode(F.sequence("_a", "_z", F.lit(HALF))).alias("_t"), F.lit(None).cast("double").alias("_v"), F.lit(0).alias("_obs"))
    return obs.unionByName(marks).groupBy(*keys, "_t").agg(F.max("_v").alias("_v"), F.sum("_obs").alias("_obs")), span.select(*keys, "_first", "_last")


def _filled(rows: DataFrame, keys: list[str], center: bool) -> DataFrame:
    """fill_edges in blocks (_b): rows within an hour of a block's border are in both blocks. Kept of the foreign ones
    (_own is false) is the mark on the border, the last row of the block before it."""
    edges = F.array_distinct(F.array(*[scan.block_of(F.col("_t") + d, scan.MICROS) for d in (0, -2 * HALF - 1, 2 * HALF)]))
    dealt = rows.withColumn("_b", F.explode(edges))
    dealt = dealt.withColumn("_own", F.col("_b") == scan.block_of(F.col("_t"), scan.MICROS))
    w = Window.partitionBy(*keys, "_b").orderBy("_t")
    seen = (F.col("_obs") > 0) & (F.col("_v") >= 0)
    before, after = (F.last(F.when(seen, F.col("_v")), ignorenulls=True).over(w.rangeBetween(*r)) for r in ((-2 * HALF, 0), (0, 2 * HALF)))
    edge = F.col("_t") % (2 * HALF) == (HALF if center else 0)
    value = F.when(F.col("_v").isNotNull(), F.col("_v")).when(edge & before.isNotNull() & after.isNull(), before).when(edge & before.isNull() & after.isNotNull(), after)
    return dealt.withColumn("_v", value).where(F.col("_own") | (F.col("_t") == (F.col("_b") + 1) * scan.MICROS))


def fill_edges(rows: DataFrame, keys: list[str], center: bool = False) -> DataFrame:
    """Marks on an hour's edge (minute 0, or 30 if centred) with observations only in the hour before take the last one of
    them, with ones only in the hour after the last of that hour; others stay."""
    return _filled(rows, keys, center).where("_own").drop("_b", "_own")


def resample_hourly(df: DataFrame, keys: list[str], ts: str, value: str, center: bool = False) -> DataFrame:
    """Volume-preserving hourly means of irregular observations: keys, hour, value, n_obs, n_obs_right, based_on_obs.

    Half-hour marks are added between the first and the last observation and filled at the edges of hours (fill_edges);
    other gaps are interpolated in time. Trapezoids between neighbouring times are summed by hour and divided by 3600.
    An hour without an observation inside or on either edge is null. Hours lie between a site's first and last
    observation.
    """
    half = HALF
    rows, span = half_hour_marks(df, keys, ts, value)
    # A block's last trapezoid ends at the mark on its border, which is a row of it too.
    rows = scan.neighbours(written(_filled(rows, keys, center), "marks"), keys, "_t", ["_v"])
    rows = rows.withColumn("_v", scan.between("_v", "_t"))
    w = Window.partitionBy(*keys, "_b").orderBy("_t")
    volume = (F.col("_v") + F.lead("_v").over(w)) / 2 * (F.lead("_t").over(w) - F.col("_t")) / 1e6
    at = F.col("_t") + (half if center else 0)
    rows = rows.select(*keys, "_own", "_obs", volume.alias("_vol"), at.alias("_at"), F.floor(at / (2 * half)).alias("_h")).where("_own")
    # An observation on an hour's edge counts for the hour that ends there too.
    right = F.array(F.struct(F.col("_h").alias("h"), F.col("_vol").alias("vol"), F.col("_obs").alias("l"), F.when(F.col("_at") % (2 * half) != 0, F.col("_obs")).otherwise(0).alias("r")), F.struct((F.col("_h") - 1).alias("h"), F.lit(None).cast("double").alias("vol"), F.lit(0).cast("long").alias("l"), F.col("_obs").alias("r")))
    both = F.when((F.col("_at") % (2 * half) == 0) & (F.col("_obs") > 0), right).otherwise(F.slice(right, 1, 1))
    hours = rows.select(*keys, F.explode(both).alias("x")).groupBy(*keys, F.col("x.h").alias("_h")).agg(F.coalesce(F.sum("x.vol"), F.lit(0.0)).alias("_vol"), F.sum("x.l").alias("n_obs"), F.sum("x.r").alias("n_obs_right"))
    hours = hours.join(span, keys).where((F.col("_h") * 2 * half).between(F.col("_first"), F.col("_last")))
    based = (F.col("n_obs") + F.col("n_obs_right")) > 0
    return hours.select(*keys, F.timestamp_micros((F.col("_h") * 2 * half).cast("long")).alias("hour"), F.when(based, F.col("_vol") / 3600).alias("value"), F.col("n_obs").cast("long").alias("n_obs"), F.col("n_obs_right").cast("long").alias("n_obs_right"), based.cast("int").alias("based_on_obs"))


def hour_windows(df: DataFrame, ts: str, center: bool = False) -> DataFrame:
    """df with hour, the hour whose window holds the row, both ends included: [hour, hour + 1 h], or half an hour to
    either side if centred. A row on an edge is dealt to both hours, so no range join is needed."""
    at = micros(F.col(ts)) + (HALF if center else 0)
    h = F.floor(at / (2 * HALF))
    rows = df.withColumn("_h", F.explode(F.when(at % (2 * HALF) == 0, F.array(h - 1, h)).otherwise(F.array(h))))
    return rows.withColumn("hour", F.timestamp_micros((F.col("_h") * 2 * HALF).cast("long"))).drop("_h")


def hourly_quality(df: DataFrame, keys: list[str], ts: str, code: str, order: tuple[str, ...] = USGS_ORDER, flags: dict[str, Column] | None = None, center: bool = False) -> DataFrame:
    """keys, hour, quality (worst code in the hour, both ends included), one 0/1 column per flag.

    An observation on an edge counts in both hours (hour_windows). A null code is 'nan'; codes that aren't listed are reported as such, ranked before all others.
    """
    name = F.coalesce(F.col(code), F.lit("nan"))
    rank = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(order) for x in (c, i)]), name), F.lit(-1))
    made = {k: F.max(F.coalesce(c.cast("int"), F.lit(0))).alias(k) for k, c in (flags or {}).items()}
    out = hour_windows(df, ts, center).groupBy(*keys, "hour").agg(F.min_by(name, F.struct(rank, name)).alias("quality"), *made.values())
    return out.select(*keys, "hour", "quality", *made)


def wsc_code(approval: Column, grade: Column) -> Column:
    """approval:grade, the Canadian code; a null is nan in either place."""
    return F.concat_ws(":", F.coalesce(approval.cast("string"), F.lit("nan")), F.coalesce(grade.cast("string"), F.lit("nan")))


def hourly_quality_can(df: DataFrame, keys: list[str], ts: str, approval: str, grade: str, center: bool = False) -> DataFrame:
    """hourly_quality of Canadian codes, with is_ice (grade 10 in the hour)."""
    rows = df.withColumn("_code", wsc_code(F.col(approval), F.col(grade)))
    return hourly_quality(rows, keys, ts, "_code", WSC_ORDER, {"is_ice": F.col(grade) == 10}, center)


def interpolate_time(df: DataFrame, keys: list[str], ts: str, cols: list[str]) -> DataFrame:
    """Linear in time between the valid values on both sides; nothing is extrapolated. ts: microseconds, a time or a date,
    once per key. Both sides are running values within a block and what other blocks carry over."""
    t, width = scan.number_of(df, ts)
    rows = df.withColumn("_at", t).withColumn("_b", scan.block_of(F.col("_at"), width))
    rows = scan.neighbours(rows, keys, "_at", cols)
    return rows.withColumns({c: scan.between(c, "_at") for c in cols}).select(*df.columns)


def reindex(df: DataFrame, keys: list[str], ts: str, step: str = "1 DAY", value: str | None = None, flags: list[str] = (), text: list[str] = ()) -> DataFrame:
    """Every step between a site's first and last time; new rows have nulls and is_new 1. With a value column, wherever
    it is null (in old rows too) the flags are 0 and the text columns, such as the quality, null."""
    span = df.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_z"))
    axis = span.select(*keys, F.explode(F.sequence("_a", "_z", F.expr(f"INTERVAL {step}"))).alias(ts))
    rows = axis.join(df.withColumn("_old", F.lit(1)), [*keys, ts], "left").withColumn("is_new", F.col("_old").isNull().cast("int")).drop("_old")
    if value is None:
        return rows
    known = F.col(value).isNotNull()
    return rows.withColumns({c: F.when(known, F.col(c)).otherwise(F.lit(0)) for c in flags} | {c: F.when(known, F.col(c)) for c in text})


def reindex_daily(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Every day between a site's first and last; new rows have nulls and is_new 1."""
    return reindex(df, keys, day)


def add_leap_days(df: DataFrame, keys: list[str], day: str, cols: list[str]) -> DataFrame:
    """Adds the 31st of December of leap years where a series of 365-day years lacks it, inside its span: the columns by
    interpolation, and yearday 366; is_new tells these rows. Other gaps stay."""
    span = df.groupBy(*keys).agg(F.min(day).alias("_a"), F.max(day).alias("_z"))
    years = span.select(*keys, "_a", "_z", F.explode(F.sequence(F.year("_a"), F.year("_z"))).alias("_y"))
    last = F.make_date("_y", F.lit(12), F.lit(31))
    wanted = years.where((F.dayofyear(last) == 366) & (last > F.col("_a")) & (last < F.col("_z"))).select(*keys, last.alias(day))
    new = wanted.join(df.select(*keys, day), [*keys, day], "left_anti").withColumn("is_new", F.lit(1))
    rows = df.withColumn("is_new", F.lit(0)).unionByName(new, allowMissingColumns=True)
    filled = interpolate_time(rows.withColumns({f"_{c}": F.col(c) for c in cols}), keys, day, [f"_{c}" for c in cols])
    made = {c: F.when(F.col("is_new") == 1, F.col(f"_{c}")).otherwise(F.col(c)) for c in cols}
    return filled.withColumns(made | {"yearday": F.dayofyear(day)}).drop(*[f"_{c}" for c in cols])


def full_years(df: DataFrame, keys: list[str], day: str, by_water_year: bool = False) -> DataFrame:
    """The longest run of whole years: from the first Jan-1 (Oct-1) that exists in a year before the last, to the last
    Dec-31 (Sep-30) that exists in a year after that of the start (one whole calendar year by itself is not
    enough). None: all rows stay."""
    (m0, d0), (m1, d1) = ((10, 1), (9, 30)) if by_water_year else ((1, 1), (12, 31))
    on = lambda m, d: F.when((F.month(day) == m) & (F.dayofmonth(day) == d), F.col(day))
    per = df.groupBy(*keys).agg(F.collect_set(on(m0, d0)).alias("_s"), F.max(on(m1, d1)).alias("_end"), F.max(F.year(day)).alias("_ly"))  # one day a year
    start = F.array_min(F.filter("_s", lambda x: F.year(x) < F.col("_ly")))
    per = per.withColumn("_start", start).select(*keys, "_start", F.when(F.year("_end") > F.year("_start"), F.col("_end")).alias("_end"))
    rows = df.join(per, keys).where(F.col("_end").isNull() | F.col(day).between(F.col("_start"), F.col("_end")))
    return rows.select(*df.columns)


def resample(df: DataFrame, keys: list[str], ts: str, freq: str, aggs: dict[str, Column]) -> DataFrame:
    """Aggregates by day, month, year and so on: keys, period and the named aggregates (built-in or user functions)."""
    return df.groupBy(*keys, F.date_trunc(freq, ts).alias("period")).agg(*[c.alias(k) for k, c in aggs.items()])


def add_time_bounds(df: DataFrame, ts: str, kind: str) -> DataFrame:
    """bounds_start and bounds_end in minutes around ts: ending, starting, centred or daily periods."""
    a, z = {"ending": (-60, 0), "starting": (0, 60), "centred": (-30, 30), "daily": (0, 1440)}[kind]
    at = micros(F.col(ts))
    return df.withColumns({"bounds_start": F.timestamp_micros(at + a * 60_000_000), "bounds_end": F.timestamp_micros(at + z * 60_000_000)})


def run_lengths(df: DataFrame, keys: list[str], ts: str, cond: Column, include_open: bool = False) -> DataFrame:
    """keys, run_start, length of each run of true; null counts as false; a run still open at the end isn't counted."""
    t, width = scan.number_of(df, ts)
    rows = df.select(*keys, ts, F.coalesce(cond, F.lit(False)).alias("_c"), t.alias("_at"))
    rows = scan.runs(rows.withColumn("_b", scan.block_of(F.col("_at"), width)), keys, "_at", "_c")
    runs = rows.where("_c").groupBy(*keys, "_run").agg(F.min(ts).alias("run_start"), F.count("*").alias("length"), F.max("_last").alias("_open"))
    return (runs if include_open else runs.where("not _open")).drop("_run", "_open")


def period_stats(df: DataFrame, keys: list[str], ts: str, conds: dict[str, Column], steps_per_day: int = 1, empty: float | None = 0.0) -> DataFrame:
    """keys and kind of each condition: frequency (days a year), mean, median, skew and kurtosis of run lengths in
    days, season with most true steps (ties: the first by name; none without a true step).

    Missing steps count as false; a run still open at the end isn't counted; without any run the four are `empty`. Runs are
    numbered block by block, and counted before they are shuffled.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(c, F.lit(False)).alias("c")) for k, c in conds.items()])
    t, width = scan.number_of(df, ts)
    rows = df.select(*keys, season(F.month(ts)).alias("_s"), t.alias("_t"), F.explode(pairs).alias("_x")).select(*keys, "_s", "_t", scan.block_of(F.col("_t"), width).alias("_b"), "_x.kind", "_x.c")
    by, names = [*keys, "kind"], ("djf", "jja", "mam", "son")
    rows = scan.runs(rows, by, "_t", "c")
    runs = rows.groupBy(*by, "_run").agg(F.count("*").alias("n"), F.bool_or("c").alias("c"), F.bool_or("_last").alias("open"), *[F.count_if(F.col("c") & (F.col("_s") == x)).alias(x) for x in names])
    days = F.when(F.col("c") & ~F.col("open"), F.col("n") / float(steps_per_day))
    stats = {"mean": F.avg(days), "median": F.median(days), "skew": F.skewness(days), "kurtosis": F.kurtosis(days)}
    out = runs.groupBy(*by).agg((F.sum(F.when(F.col("c"), F.col("n")).otherwise(0)) / F.sum("n") * 365.25).alias("frequency"), F.count(days).alias("_n"), *[F.nanvl(c, F.lit(None).cast("double")).alias(k) for k, c in stats.items()], *[F.sum(x).alias(x) for x in names])
    best, top = F.greatest(*names), F.lit(None).cast("string")
    for x in reversed(names):
        top = F.when((F.col(x) == best) & (best > 0), x).otherwise(top)
    filled = {k: F.when(F.col("_n") == 0, F.lit(empty).cast("double")).otherwise(F.col(k)) for k in stats}
    return out.withColumns(filled).select(*keys, "kind", "frequency", *stats, top.alias("season"))


def mean_daily_max(df: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """df with mean_max: the mean over years of the day's maximum, by month and day (so leap years line up)."""
    md = F.date_format(day, "MM-dd")
    daily = df.groupBy(*keys, md.alias("_md"), F.year(day).alias("_y")).agg(F.max(value).alias("_m"))
    mean = daily.groupBy(*keys, "_md").agg(F.avg("_m").alias("mean_max"))
    return df.withColumn("_md", md).join(mean, [*keys, "_md"]).drop("_md")
