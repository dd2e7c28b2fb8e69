"""Sharding by a k-d tree: nodes are split at weighted medians along their widest metadata dimension.

The items of the tree are groups of equal texts. Groups that are large against a shard are placed first, each whole in
the shard with the most room; only one that no shard can hold is dealt by doc_id to several items. A node that must
become n shards is split where the bytes on the left come closest to the share of the node's room that the left
floor(n / 2) shards have left. That place is found by histograms: one sum per bin and node, narrowed
to the bin that holds the place, until the bin is fine enough. The tree itself has one entry per split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import bucket_bits, discard, hash_bucket, running_total, staged

SHARDS = 24
#: A group of equal texts over this share of a shard's bytes is placed before the tree; there are at most
#: shards / LARGE of them. One that no shard can hold is dealt to items of an eighth of that share.
LARGE = 0.1
#: Bits of a dimension's key: metadata value, then a hash that orders rows of equal value. Histogram bins per round.
VALUE_BITS, TIE_BITS, BINS = 20, 42, 1 << 16
#: A bin this light against a shard is not narrowed further.
FINE = 0.0005


@dataclass
class Node:
    """A node of one level: the shards from `first` on that it becomes, and while its split is sought the dimension,
    the bin range that holds the place (low, width), the bytes below it, and the bytes that belong to the left."""

    first: int
    shards: int
    dim: int = 0
    low: int = 0
    width: int = 1
    below: int = 0
    goal: float = 0.0
    at: int | None = None  # the first key of the right side


def ranked(values: DataFrame, column: str) -> DataFrame:
    """value, rank: the distinct values of a column numbered in code point order from 0.

    They are dealt to ordered ranges and numbered there; only one count per range meets in a window.
    """
    spread = values.select(F.col(column).alias("value")).distinct().repartitionByRange("value").withColumn("part", F.spark_partition_id())
    spread = staged(spread, "shard-values")
    sums = spread.groupBy("part").agg(F.count("*").alias("n"))
    before = sums.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = spread.withColumn("i", F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1)
    return staged(inner.join(before, "part").select("value", (F.col("i") + F.col("before")).alias("rank")), "shard-ranks")


def place_large(groups: list, shards: int, room: float) -> tuple[list[tuple[int | None, int]], list[float]]:
    """((shard or None, pieces) of each group, the room left in each shard): the largest first, each into the shard
    with the most room. A group that doesn't fit there is to be dealt to pieces."""
    left = [room] * shards
    placed: list[tuple[int | None, int]] = [(None, 1)] * len(groups)
    for i in sorted(range(len(groups)), key=lambda i: (-groups[i].bytes, groups[i].h, groups[i].text_crc32)):
        best = max(range(shards), key=lambda s: (left[s], -s))
        if groups[i].bytes <= left[best]:
            left[best] -= groups[i].bytes
            placed[i] = (best, 1)
        else:
            placed[i] = (None, -(-groups[i].bytes // max(1, int(room * LARGE / 8))))
    return placed, left


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document; sizes of shards are near equal.

    Size: UTF-8 bytes of the text (null: none) plus 8. Dimensions: the logarithm of the size, and the place of lang and
    source among their distinct values (those that the table has; null counts as empty; a group of equal texts takes
    its lowest). Equal texts share a shard wherever one can hold them. Texts of any length are hashed where they stand.
    Slots are gapless from 0 in each shard, in the order of a hash. Repeated rows are separate rows; an empty table
    gives an empty result; with fewer items than shards some shards stay empty; other columns aren't read.
    """
    metadata = [c for c in ("lang", "source") if c in documents.columns]
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.xxhash64(text).alias("h"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in metadata])
    rows = staged(rows, "shard-rows")
    totals = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"), F.count("*").alias("n"), F.log2(F.min("size")).alias("low"), F.log2(F.max("size")).alias("high")).first()
    room, group = totals.total / shards, ["h", "text_crc32", "size"]
    grouped = rows.groupBy(*group).agg(F.sum("size").alias("bytes"), *[F.min(f"_{c}").alias(f"_{c}") for c in metadata])
    grouped = staged(grouped, "shard-groups")
    large = grouped.where(F.col("bytes") > max(1.0, room * LARGE)).select(*group, "bytes").collect()
    placed, left = place_large(large, shards, room)
    known = [F.struct(F.lit(g.h).alias("h"), F.lit(g.text_crc32).cast("long").alias("text_crc32"), F.lit(g["size"]).cast("long").alias("size"), F.lit(at).cast("int").alias("_own"), F.lit(pieces).cast("int").alias("_pieces")) for g, (at, pieces) in zip(large, placed, strict=True)]
    none = F.array().cast("array<struct<h:bigint,text_crc32:bigint,size:bigint,_own:int,_pieces:int>>")
    # At most shards / LARGE rows.
    few = F.broadcast(documents.sparkSession.range(1).select(F.explode(F.array(*known) if known else none).alias("g")).select("g.*"))
    dealt = rows.join(few, group, "left").withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.coalesce("_pieces", F.lit(1))).cast("int"))
    whole = grouped.join(few.where("_own is not null or _pieces > 1"), group, "left_anti").withColumn("piece", F.lit(0))
    pieces = dealt.where("_pieces > 1").groupBy(*group, "piece").agg(F.sum("size").alias("bytes"), *[F.min(f"_{c}").alias(f"_{c}") for c in metadata])
    items = whole.unionByName(pieces)
    keys = {"_size": sort_key(F.log2("size"), totals.low or 0.0, totals.high or 0.0)}
    for c in metadata:
        ranks = ranked(rows, f"_{c}")
        items = items.join(ranks.select(F.col("value").alias(f"_{c}"), F.col("rank").alias(f"_r{c}")), f"_{c}")
        keys[f"_{c}"] = sort_key(F.col(f"_r{c}"), 0, max(ranks.count() - 1, 0))
    items = items.withColumn("tie", F.shiftrightunsigned(F.xxhash64("h", "piece", "text_crc32"), 64 - TIE_BITS))
    items = staged(items.select(*group, "piece", "bytes", *[e.alias(f"k{d}") for d, e in keys.items()]), "shard-items")
    items = tree(items, [f"k{d}" for d in keys], left, FINE * room).select(*group, "piece", F.col("shard").alias("_shard"))
    own = dealt.where("_own is not null").withColumn("shard", F.col("_own"))
    rest = dealt.where("_own is null").join(items, [*group, "piece"]).withColumn("shard", F.col("_shard")).drop("_shard")
    out = ["doc_id", "h", "size", "text_crc32", "shard"]
    placed = own.select(*out).unionByName(rest.select(*out))
    placed = placed.withColumn("order", F.xxhash64("doc_id", "h")).withColumn("bucket", hash_bucket(F.col("order"), bucket_bits(totals.n)))
    slots = running_total(placed, ["shard"], "bucket", ["order", "doc_id", "h"], F.lit(1), "slot")
    return slots.select("doc_id", "size", "text_crc32", "shard", "slot")


def sort_key(value: Column, low: float, high: float) -> Column:
    """A long that orders items by the dimension's value (in 2 ** VALUE_BITS steps over its range), then by the tie."""
    scale = ((1 << VALUE_BITS) - 1) / (high - low) if high > low else 0.0
    return F.shiftleft(F.floor((value - F.lit(low)) * F.lit(scale)).cast("long"), TIE_BITS) + F.col("tie")


def by_node(values: list, kind: str) -> Column:
    """The entry of the row's node in a list with one entry per node of the level (at most one per shard)."""
    return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("node"))


def tree(items: DataFrame, keys: list[str], room: list[float], fine: float) -> DataFrame:
    """items with shard; room is what each shard can take. Each level writes the items with their node; the levels are
    log2(shards)."""
    nodes, first = [Node(0, len(room))], items.withColumn("node", F.lit(0))
    level = first
    while any(n.shards > 1 for n in nodes):
        median_splits(level, keys, nodes, room, fine)
        children, left = [], []
        for node in nodes:
            half = node.shards // 2
            left.append(len(children))
            children += [Node(node.first, half), Node(node.first + half, node.shards - half)] if half else [node]
        right = (node_key(keys, nodes) >= by_node([n.at for n in nodes], "long")) & by_node([n.shards > 1 for n in nodes], "boolean")
        old, level = level, staged(level.withColumn("node", by_node(left, "int") + right.cast("int")), "shard-level")
        if old is not first:
            discard(old)
        nodes = children
    return level.withColumn("shard", by_node([n.first for n in nodes], "int"))


def node_key(keys: list[str], nodes: list[Node]) -> Column:
    """The row's key along the dimension of its node."""
    return F.get(F.array(*keys), by_node([n.dim for n in nodes], "int"))


def share(room: list[float], node: Node) -> float:
    """The left half's share of the room that the node's shards have."""
    own = room[node.first : node.first + node.shards]
    return sum(own[: node.shards // 2]) / sum(own) if sum(own) > 0 else 0.5


def median_splits(items: DataFrame, keys: list[str], nodes: list[Node], room: list[float], fine: float) -> None:
    """Sets dim and at of every node that is to be split."""
    found = items.groupBy("node").agg(F.sum("bytes").alias("bytes"), *[f(d).alias(f"{name}{d}") for d in keys for name, f in (("min", F.min), ("max", F.max))])
    spans = {r.node: r for r in found.collect()}
    for i, node in enumerate(nodes):
        node.at = 0
        if node.shards > 1 and (r := spans.get(i)) is not None:
            spread = [(r[f"max{d}"] >> TIE_BITS) - (r[f"min{d}"] >> TIE_BITS) for d in keys]
            node.dim = spread.index(max(spread))
            node.low, top = r[f"min{keys[node.dim]}"], r[f"max{keys[node.dim]}"]
            node.width, node.below, node.goal, node.at = top - node.low + 1, 0, r.bytes * share(room, node), None
    while any(n.at is None for n in nodes):
        steps = [-(-n.width // BINS) for n in nodes]
        rows = items.where(by_node([n.at is None for n in nodes], "boolean"))
        rows = rows.select("node", "bytes", (node_key(keys, nodes) - by_node([n.low for n in nodes], "long")).alias("off"), by_node(steps, "long").alias("step"))
        bins = rows.where((F.col("off") >= 0) & (F.col("off") < F.col("step") * BINS)).groupBy("node", F.expr("off div step").alias("bin")).agg(F.sum("bytes").alias("bytes"))
        upto = bins.withColumn("upto", F.sum("bytes").over(Window.partitionBy("node").orderBy("bin")))  # at most BINS rows a node
        want = by_node([float(n.goal - n.below) for n in nodes], "double")
        first = upto.where(F.col("upto") >= want).groupBy("node").agg(F.min_by(F.struct("bin", "upto", "bytes"), "bin").alias("x"))
        for i, x in ((r.node, r.x) for r in first.collect()):
            node, step = nodes[i], steps[i]
            before, start = node.below + x.upto - x.bytes, node.low + x.bin * step
            if step == 1 or x.bytes <= fine:
                node.at = start if node.goal - before <= before + x.bytes - node.goal else start + step
            else:
                node.low, node.width, node.below = start, step, before
