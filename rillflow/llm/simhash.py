"""SimHash near-dedup by pigeonhole blocks.

Documents get 64-bit fingerprints. Fingerprints link when they differ in few bits. They are split into m blocks; two
that differ in at most d bits agree in at least m - d blocks, so each choice of m - d blocks is one table, keyed by those
blocks' bits, and a linked pair meets in some table. Only distinct fingerprints are compared. A key's group of
fingerprints gives the edges of a spanning forest, not all pairs. Components of the edges join the documents again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import discard, staged

WORDS_PER_SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Fingerprints of one key that one task compares at a time; a larger group is compared chunk by chunk, in many tasks.
GROUP = 16_384
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str | None, k: int = WORDS_PER_SHINGLE) -> int:
    """A bit is 1 if set in over half of the shingles' XXH64 values; 0 without words."""
    import xxhash

    ws = (text or "").encode().translate(_LOWER).split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= k:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
    starts = [0, *ends[: len(ws) - k].tolist()]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):
        ones += np.unpackbits(h[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, columns: list[str], k: int = WORDS_PER_SHINGLE) -> DataFrame:
    """The columns with fp, the fingerprint as a signed long. Null and empty texts have fingerprint zero."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), k) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(fps.view(np.int64), pa.int64())], names=[*columns, "fp"])

    rows = documents.select(*dict.fromkeys([*columns, "text"]))
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(apply, f"{schema}, fp long")


def tables(n: int, distance: int = DISTANCE) -> list[int]:
    """Bit masks of the tables: the fewest blocks whose keys have bits enough that unrelated ones of n seldom meet."""
    m = distance + 1
    while 64 * (m - distance) // m < (8 * max(n, 1)).bit_length() and m < 16:
        m += 1
    edges = np.linspace(0, 64, m + 1).astype(int).tolist()
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, m - distance)]


def near(fps: np.ndarray, one: np.uint64, distance: int) -> np.ndarray:
    return np.bitwise_count(fps ^ one) <= distance


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the link graph on these distinct fingerprints: breadth first, each reached
    fingerprint takes the ones still unreached that link to it."""
    left, edges = fps.astype(np.uint64), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            hit = near(left, one, distance)
            if hit.any():
                new = left[hit]
                left = left[~hit]
                edges += [(int(one), int(x)) for x in new]
                queue.extend(new)
    return edges


def between(a: np.ndarray, b: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Enough links between two chunks to connect what they connect together with each chunk's own forest."""
    own = {}
    for part in (a, b):
        root = {int(x): int(x) for x in part}

        def find(x, root=root):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x, y in forest(part, distance):
            root[find(x)] = find(y)
        own |= {x: find(x) for x in root}
    edges, met = [], set()
    b_roots = np.array([own[int(x)] for x in b], np.uint64)
    for x in a.astype(np.uint64):
        hit = near(b.astype(np.uint64), x, distance)
        if hit.any():
            for r, i in dict(zip(b_roots[hit].tolist(), np.flatnonzero(hit).tolist(), strict=True)).items():
                if (own[int(x)], r) not in met:
                    met.add((own[int(x)], r))
                    edges.append((int(x), int(b[i])))
    return edges


def links(distinct: DataFrame, n: int, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Edges (a, b) among distinct fingerprints (column fp) that give the components of all links."""
    masks = tables(n, distance)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    key = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)]))
    rows = distinct.select("fp", key.alias("k")).select("k.t", "k.key", "fp")
    counts = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    # Spark sizes exploded rows like the fingerprints before them; a merge join sends neither side through the driver.
    shared = staged(rows.hint("merge").join(counts, ["t", "key"]), "simhash-keys")
    # Larger groups are split into c chunks by a hash; each pair of chunks (i <= j) is a task's work of bounded size.
    chunks = F.ceil(F.col("n") / group).cast("int")
    mine = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    few = shared.where(F.col("n") <= group).select("t", "key", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "fp")
    many = shared.where(F.col("n") > group).withColumn("c", mine).withColumn("o", F.explode(F.sequence(F.lit(0), chunks - 1)))
    many = many.select("t", "key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), F.when(F.col("c") <= F.col("o"), 0).otherwise(1).alias("side"), "fp")
    parts = ["t", "key", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(cols: list[np.ndarray], heads: np.ndarray, ends: np.ndarray):
            t, key, i, j, side, fp = cols
            size = ends - heads
            two = heads[(size == 2) & (i[heads] == j[heads])]
            a, b = fp[two].view(np.uint64), fp[two + 1].view(np.uint64)
            ok = np.bitwise_count(a ^ b) <= distance
            found = list(zip(a[ok].tolist(), b[ok].tolist(), strict=True))
            for h, e in zip(heads.tolist(), ends.tolist(), strict=True):
                if i[h] != j[h]:
                    one, other = fp[h:e][side[h:e] == 0].view(np.uint64), fp[h:e][side[h:e] == 1].view(np.uint64)
                    found += between(one, other, distance)
                elif e - h > 2:
                    found += forest(fp[h:e].view(np.uint64), distance)
            out = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(out.min(1)), pa.array(out.max(1))], names=["a", "b"]) if len(out) else None

        rest: list[np.ndarray] | None = None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in [*parts, "side", "fp"]]
            cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)] if rest else cols
            if not len(cols[0]):
                continue
            new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:4]])) + 1
            heads = np.concatenate([[0], new])
            last = heads[-1]  # this group may go on in the next batch
            if len(heads) > 1 and (out := edges([c[:last] for c in cols], heads[:-1], heads[1:])):
                yield out
            rest = [c[last:] for c in cols]
        if rest and (out := edges(rest, np.zeros(1, np.int64), np.array([len(rest[0])]))):
            yield out

    dealt = few.unionByName(many).repartition(*parts).sortWithinPartitions(*parts, "side", "fp")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node of each connected component, for nodes that have an edge.

    Alternating large-star and small-star steps; every step is written to the shared folder, so lineage stays short,
    and the step before it is deleted. Each step writes a minimum per node (summed before it is shuffled) and joins
    that table: Spark sends it to all tasks if it is small, and else splits the partition that holds a hub's edges, as
    both sides are plain shuffles of written tables.
    """
    current = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    count = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
    for _ in range(rounds):
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large-low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, "large-star")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "small-low")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        old, current = current, staged(small, "small-star")
        for done in (old, low, large, least):
            discard(done)
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if now == count:
            break
        count = now
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))


def near_duplicates(documents: DataFrame, columns: list[str] = ("doc_id",), distance: int = DISTANCE) -> DataFrame:
    """The columns of every document with fp, group (the smallest fingerprint of its component) and component_id.

    component_id is the smallest doc_id of the component, its own included; null doc_ids count only where all are
    null. Null and empty texts have fingerprint zero and link like others. Repeated rows stay, each with the same
    component; texts of any length are hashed whole. An empty table gives an empty result. The joins read written
    tables, so Spark can split the rows of a fingerprint or group that a large part of the documents shares.
    """
    columns = list(dict.fromkeys(["doc_id", *columns]))
    fps = staged(fingerprints(documents, columns), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    distinct = staged(distinct, "distinct-fingerprints")
    nodes = components(links(distinct.select("fp"), distinct.count(), distance))
    grouped = distinct.join(nodes, distinct["fp"] == nodes["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("group"))
    grouped = staged(grouped, "fingerprint-groups")
    lowest = staged(grouped.groupBy("group").agg(F.min("low").alias("component_id")), "lowest")
    of = staged(grouped.select("fp", "group").join(lowest, "group"), "fingerprint-components")
    return fps.join(of, "fp").select(*columns, "fp", "group", "component_id")
