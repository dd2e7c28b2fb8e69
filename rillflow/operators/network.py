"""River networks: (basin, comid, next_down, up1..up4, length, ...). Null or 0 in a link means none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.operators.shared import discard, written

UPS = ("up1", "up2", "up3", "up4")


def find_outlets(net: DataFrame) -> DataFrame:
    """Segments whose next_down isn't in their basin's network."""
    ids = net.select("basin", F.col("comid").alias("next_down")).distinct()
    return net.join(ids, ["basin", "next_down"], "left_anti").select("basin", "comid", "next_down")


def rounds_of(net: DataFrame) -> int:
    """So many doublings pass every segment of a path; pointers that are left after them lead into a cycle."""
    return max(1, net.count()).bit_length() + 1


def stream_lengths(net: DataFrame) -> DataFrame:
    """basin, comid, stream_length: from every headwater (a segment that nothing flows into) down until the path leaves
    the network. Pointers double in every round, so a path of n segments takes log2(n) joins; a path into a cycle,
    which never leaves, gets a null."""
    first = net.select("basin", "comid", F.nullif("next_down", F.lit(0)).alias("to"), F.col("length").cast("double").alias("sum"))
    current = written(first.join(first.select("basin", F.col("comid").alias("to"), F.lit(1).alias("in")), ["basin", "to"], "left").select("basin", "comid", F.when(F.col("in") == 1, F.col("to")).alias("to"), "sum"), "lengths")
    for _ in range(rounds_of(net)):
        step = current.select("basin", F.col("comid").alias("to"), F.col("to").alias("to2"), F.col("sum").alias("sum2"))
        old, current = current, written(current.join(step, ["basin", "to"], "left").select("basin", "comid", F.col("to2").alias("to"), (F.col("sum") + F.coalesce("sum2", F.lit(0.0))).alias("sum")), "lengths")
        discard(old)
        if current.where("to is not null").isEmpty():
            break
    fed = net.select("basin", F.col("next_down").alias("comid")).distinct()
    return current.join(fed, ["basin", "comid"], "left_anti").select("basin", "comid", F.when(F.col("to").isNull(), F.col("sum")).alias("stream_length"))


def upstream(net: DataFrame, ids: DataFrame) -> DataFrame:
    """(basin, comid, member): each given segment with all segments upstream of it, itself included. Jumps double in
    every round, so a path of n segments takes log2(n) rounds; a round that reaches nothing new is the last."""
    jumps = net.select("basin", F.col("next_down").alias("member"), F.col("comid").alias("up")).where("member is not null and member <> 0").distinct()
    reached = ids.join(net.select("basin", "comid"), ["basin", "comid"], "left_semi").select("basin", "comid", F.col("comid").alias("member")).distinct()
    while True:
        newest = written(reached.join(jumps, ["basin", "member"]).select("basin", "comid", F.col("up").alias("member")).distinct().join(reached, ["basin", "comid", "member"], "left_anti"))
        if newest.isEmpty():
            return reached
        reached = written(reached.unionByName(newest))
        jumps = written(jumps.withColumnRenamed("up", "by").join(jumps.withColumnRenamed("member", "by"), ["basin", "by"]).select("basin", "member", "up").distinct())


def accumulated(net: DataFrame, values: dict[str, Column]) -> DataFrame:
    """basin, comid and each value summed over the segment and all that drains to it, for every segment.

    After k rounds a segment has the sum over all segments less than 2^k steps above it; each round adds the sums of
    those that are 2^k steps above. So the tables keep one row per segment, whatever the depth. Segments on a cycle,
    which have no end of steps above them, take the sum over the set of segments above instead.
    """
    first = net.select("basin", "comid", F.nullif("next_down", F.lit(0)).alias("to"), *[c.alias(k) for k, c in values.items()])
    known = net.select("basin", F.col("comid").alias("to"), F.lit(1).alias("in"))
    current = written(first.join(known, ["basin", "to"], "left").select("basin", "comid", F.when(F.col("in") == 1, F.col("to")).alias("to"), *values), "sums")
    for _ in range(rounds_of(net)):
        above = current.where("to is not null").groupBy("basin", F.col("to").alias("comid")).agg(*[F.sum(k).alias(f"_{k}") for k in values])
        jump = current.select("basin", F.col("comid").alias("to"), F.col("to").alias("to2"))
        step = current.join(jump, ["basin", "to"], "left").join(above, ["basin", "comid"], "left")
        old, current = current, written(step.select("basin", "comid", F.col("to2").alias("to"), *[F.when(F.col(f"_{k}").isNull(), F.col(k)).otherwise(F.col(k) + F.col(f"_{k}")).alias(k) for k in values]), "sums")
        discard(old)
        if (done := current.where("to is not null").isEmpty()):
            break
    if done:
        return current.drop("to")
    ring = written(current.where("to is not null").select("basin", F.col("to").alias("comid")).distinct(), "cycle")
    own = net.select("basin", F.col("comid").alias("member"), *[c.alias(k) for k, c in values.items()])
    sets = upstream(net, ring).join(own, ["basin", "member"]).groupBy("basin", "comid").agg(*[F.sum(k).alias(k) for k in values])
    return current.drop("to").join(ring, ["basin", "comid"], "left_anti").unionByName(sets)


#: Numbers of a tour that share a bucket of the range join.
SPAN = 4096


def tour(net: DataFrame) -> DataFrame:
    """basin, comid, root, entry, exit: the interval labels of a depth-first tour up the network, from each outlet (root).
    What drains to a segment has the entries from its entry to its exit. Segments on a cycle, or that drain into one, are
    reported with nulls.

    A segment's place behind the one below it is one more than what its earlier neighbours (by comid) drain; pointers
    double to add these places up along the way to the outlet.
    """
    sizes = accumulated(net, {"size": F.lit(1).cast("long")})
    known = net.select("basin", F.col("comid").alias("to"), F.lit(1).alias("in"))
    first = net.select("basin", "comid", F.nullif("next_down", F.lit(0)).alias("to")).join(known, ["basin", "to"], "left").join(sizes, ["basin", "comid"])
    first = first.withColumn("to", F.when(F.col("in") == 1, F.col("to")))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("basin", "to").orderBy("comid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = first.where("to is not null").select("basin", "comid", "to", "size", (before + 1).alias("place"))
    roots = first.where("to is null").select("basin", "comid", "to", "size", F.lit(0).cast("long").alias("place"))
    current = written(inner.unionByName(roots).withColumn("root", F.coalesce("to", "comid")), "tour")
    for _ in range(rounds_of(net)):
        step = current.select("basin", F.col("comid").alias("to"), F.col("to").alias("to2"), F.col("place").alias("place2"), F.col("root").alias("root2"))
        next_ = current.join(step, ["basin", "to"], "left").select("basin", "comid", F.col("to2").alias("to"), "size", (F.col("place") + F.coalesce("place2", F.lit(0))).alias("place"), F.coalesce("root2", "root").alias("root"))
        old, current = current, written(next_, "tour")
        discard(old)
        if current.where("to is not null").isEmpty():
            break
    ends = F.col("to").isNull()
    return current.select("basin", "comid", F.when(ends, F.col("root")).alias("root"), F.when(ends, F.col("place")).alias("entry"), F.when(ends, F.col("place") + F.col("size") - 1).alias("exit"))


def upstream_sets(net: DataFrame, ids: DataFrame) -> DataFrame:
    """basin, comid, member: each given segment (basin, comid) with all that drains to it, itself included, by the ranges
    of a tour, in buckets of SPAN numbers. Segments on a cycle, or below none of the tour, take the sets step by step."""
    labels = written(tour(net), "labels")
    asked = labels.join(ids.select("basin", "comid").distinct(), ["basin", "comid"], "left_semi")
    bucket = lambda c: F.floor(F.col(c) / SPAN)
    ranges = asked.where("root is not null").withColumn("_k", F.explode(F.sequence(bucket("entry"), bucket("exit"))))
    members = labels.where("root is not null").select("basin", "root", F.col("comid").alias("member"), F.col("entry").alias("_e"), bucket("entry").alias("_k"))
    found = ranges.join(members, ["basin", "root", "_k"]).where("_e between entry and exit").select("basin", "comid", "member")
    rest = asked.where("root is null").select("basin", "comid")
    return found if rest.isEmpty() else found.unionByName(upstream(net, rest))


def upstream_area(net: DataFrame, ids: DataFrame) -> DataFrame:
    """basin, comid, n_up, area: the sum of unit areas of each given segment and all that drains to it."""
    sums = accumulated(net, {"n_up": F.lit(1).cast("long"), "area": F.col("unitarea").cast("double")})
    return sums.join(ids.select("basin", "comid").distinct(), ["basin", "comid"], "left_semi")


def repair_links(net: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(network, change log) after segments were split: a part n.x stands for the old n. Links to a segment that is no
    longer there go to the part whose whole number it is (the lowest, if several); others stay."""
    ids = net.select("basin", "comid").distinct()
    parts = ids.where(F.col("comid") != F.floor("comid")).groupBy("basin", F.floor("comid").cast("decimal(12,2)").alias("old")).agg(F.min("comid").alias("new"))
    gone = parts.join(ids.select("basin", F.col("comid").alias("old")), ["basin", "old"], "left_anti")
    fixed, logs = net, None
    for c in ("next_down", *[u for u in UPS if u in net.columns]):
        g = gone.select(F.col("basin").alias("_b"), F.col("old").alias("_old"), F.col("new").alias("_new"))
        fixed = fixed.join(g, (F.col("basin") == F.col("_b")) & (F.col(c) == F.col("_old")), "left")
        log = fixed.where("_new is not null").select("basin", "comid", F.lit(c).alias("link"), F.col("_old").alias("old"), F.col("_new").alias("new"))
        logs = log if logs is None else logs.unionByName(log)
        fixed = fixed.withColumn(c, F.coalesce("_new", c)).drop("_b", "_old", "_new")
    return fixed, logs


def add_missing_segments(net: DataFrame, basins: DataFrame) -> DataFrame:
    """Network rows for sub-basins without a river segment: no length, the area of the sub-basin plus that of the
    segments that list it as next_down (all upstream of those included)."""
    missing = basins.join(net.select("basin", "comid"), ["basin", "comid"], "left_anti").select("basin", "comid", "unitarea")
    direct = net.select("basin", F.col("next_down").alias("comid"), F.col("comid").alias("feeder")).join(missing.select("basin", "comid"), ["basin", "comid"], "left_semi")
    own = written(accumulated(net, {"uparea": F.col("unitarea").cast("double")}), "areas")
    fed = own.select("basin", F.col("comid").alias("feeder"), F.col("uparea").alias("area"))
    above = direct.join(fed, ["basin", "feeder"]).groupBy("basin", "comid").agg(F.sum("area").alias("above"))
    rows = missing.join(above, ["basin", "comid"], "left").select("basin", "comid", "unitarea", (F.col("unitarea") + F.coalesce("above", F.lit(0.0))).alias("uparea"), F.lit(1).alias("added"))
    old = net.select("basin", "comid", "unitarea").join(own, ["basin", "comid"]).withColumn("added", F.lit(0))
    return old.unionByName(rows)


def river_attributes(net: DataFrame, basins: DataFrame) -> DataFrame:
    """Per basin: total length, stream lengths, highest order, density and elongation (basins: basin, area)."""
    total = net.groupBy("basin").agg(F.sum("length").alias("length"), F.max("order").alias("max_order"))
    s = F.col("stream_length")
    streams = stream_lengths(net).groupBy("basin").agg(F.min(s).alias("stream_min"), F.avg(s).alias("stream_mean"), F.max(s).alias("stream_max"), F.stddev_pop(s).alias("stream_std"))
    rows = basins.join(total, "basin", "left").join(streams, "basin", "left")
    return rows.withColumns({"density": F.col("length") / F.col("area"), "elongation": 2 * F.sqrt(F.col("area") / F.pi()) / F.col("stream_max")})


def subbasin_river_attributes(net: DataFrame, basins: DataFrame) -> DataFrame:
    """Per sub-basin: length, slope, upstream area, density and elongation; nulls without a river."""
    rows = basins.join(net.select("basin", "comid", "length", "slope", "uparea"), ["basin", "comid"], "left")
    return rows.withColumns({"density": F.col("length") / F.col("area"), "elongation": 2 * F.sqrt(F.col("area") / F.pi()) / F.nullif("length", F.lit(0.0))})
