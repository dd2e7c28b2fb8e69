"""Near-duplicate documents by SetSketch registers.

A document is its set of distinct five-word shingles. Each of its registers holds the minimum of an exponential variable
over the set, truncated to exponentially spaced steps: one byte each, mergeable by the larger value, and equal in two
sketches about as often as the sets' Jaccard similarity. Bands of registers are join keys. Sets that share a key are
compared by the likelihood of their registers' order, and then shingle by shingle.

Equal sets are one node from the start. A key's nodes give the edges of a spanning forest of the links among them, not
all pairs, and keys that hold the same nodes are looked at once. Whole sets lie in flat files that tasks map into memory,
so a group's rows carry only where each set is.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import discard, mounted, new_path, staged
from rillflow.llm.simhash import components
from rillflow.llm.target_ratio import marked

WORDS_PER_SHINGLE, PERCENT, SEED = 5, 85, 12
#: Base and rate of the truncation: 255 steps of a tenth, from one shingle to some 10^9 of them.
BASE, RATE = 1.1, 30.0
#: Registers of a band, and the chance at most that a pair at the threshold shares no band.
ROWS, MISSED = 5, 1e-9
#: A pair is compared unless the threshold is e^-20 times less likely than the most likely similarity below it.
LIKELIHOOD = 20.0
#: Nodes of one key that one task compares at a time; two such chunks meet in one task where a key has more.
GROUP = 4096
#: Hashes that a comparison lays side by side.
SLICE = 1 << 22
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def equal_share(u: float, j: float) -> float:
    """How often a register is equal in two sets of similarity j whose sizes are as u to 1 - u."""
    step = (BASE - 1) / BASE
    return 1 + (math.log1p(-max(0.0, u - (1 - u) * j) * step) + math.log1p(-max(0.0, 1 - u - u * j) * step)) / math.log(BASE)


def bands(percent: int = PERCENT) -> int:
    """Bands that leave a pair at the threshold without a shared one in MISSED of all cases."""
    return math.ceil(math.log(MISSED) / math.log1p(-(equal_share(0.5, percent / 100) ** ROWS)))


@cache
def hashing(m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odd multipliers and masks of m hash functions, and the largest minimum that reaches each register value."""
    rng = np.random.default_rng(SEED)
    multipliers = rng.integers(0, 1 << 31, m, np.uint32) * np.uint32(2) + np.uint32(1)
    masks = rng.integers(0, 1 << 32, m, np.uint32)
    steps = -np.expm1(-RATE * BASE ** (1.0 - np.arange(1, 256)))
    return multipliers[:, None], masks[:, None], np.sort((steps * 4294967295.0).astype(np.uint32))


def shingles(text: str | None, k: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """The sorted distinct XXH64 values of the text's k-word shingles; with fewer words, of the whole sequence."""
    import xxhash

    ws = (text or "").encode().translate(_LOWER).split()
    if not ws:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(ws), xxhash.xxh64_intdigest
    if len(ws) <= k:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
    starts = [0, *ends[: len(ws) - k].tolist()]
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)], np.uint64))


def registers(hashes: np.ndarray, m: int) -> np.ndarray:
    """The m registers of a set, block by block: the minima of blocks merge."""
    multipliers, masks, steps = hashing(m)
    h = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(m, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 256):
        mixed = h[i : i + 256] ^ masks
        mixed *= multipliers
        mixed ^= mixed >> np.uint32(15)
        mixed *= multipliers
        np.minimum(least, mixed.min(1), out=least)
    return (255 - np.searchsorted(steps, least)).astype(np.uint8)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def likely(one: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the others may reach the threshold, by the joint likelihood of lower, equal and higher registers."""
    equal = (others == one).sum(1)
    above = (others < one).sum(1)
    below = len(one) - equal - above
    u = n / (n + sizes)
    step = (BASE - 1) / BASE

    def loglik(j: float, at: np.ndarray) -> np.ndarray:
        v = 1 - u[at]
        higher = -np.log1p(-np.maximum(u[at] - v * j, 1e-9) * step) / math.log(BASE)
        lower = -np.log1p(-np.maximum(v - u[at] * j, 1e-9) * step) / math.log(BASE)
        return above[at] * np.log(higher) + below[at] * np.log(lower) + equal[at] * np.log(np.maximum(1 - higher - lower, 1e-9))

    everywhere = np.arange(len(others))
    at_threshold = loglik(threshold, everywhere)
    ok = loglik(threshold - 0.01, everywhere) <= at_threshold  # the most likely similarity is higher
    unsure = np.flatnonzero(~ok)
    if len(unsure):
        best = np.max([loglik(j, unsure) for j in np.linspace(0, threshold, 18)], axis=0)
        ok[unsure] = best - at_threshold[unsure] <= LIKELIHOOD
    return ok


class Sets:
    """Registers and hashes of the nodes of a group, read from mapped files where they are needed."""

    def __init__(self, folder: str, m: int):
        self.root, self.m, self.files = mounted(folder), m, {}

    def load(self, files: list[str], at: list[int], sizes: list[int]) -> tuple[np.ndarray, list[np.ndarray]]:
        regs, own = np.empty((len(files), self.m), np.uint8), []
        for i, (name, a, n) in enumerate(zip(files, at, sizes, strict=True)):
            if name not in self.files:
                if len(self.files) >= 256:
                    self.files.clear()
                self.files[name] = np.memmap(f"{self.root}/{name}", np.uint8, "r")
            data = self.files[name]
            regs[i] = data[a : a + self.m]
            own.append(data[a + self.m : a + self.m + 8 * n])
        return regs, own


def forest(nodes: np.ndarray, sizes: np.ndarray, regs: np.ndarray, own: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the link graph on these sets: breadth first, each reached set takes the ones still
    unreached that link to it. Sizes and likelihoods spare most comparisons of sets that don't link."""
    order = np.argsort(-sizes, kind="stable")  # any order is right
    left, edges = order, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            small, large = np.minimum(sizes[one], sizes[left]), np.maximum(sizes[one], sizes[left])
            maybe = np.flatnonzero(100 * small >= percent * large)
            if len(maybe):
                maybe = maybe[likely(regs[one], regs[left[maybe]], int(sizes[one]), sizes[left[maybe]], percent / 100)]
            if not len(maybe):
                continue
            both = shared(own[one].view(np.uint64), [own[i] for i in left[maybe].tolist()], sizes[left[maybe]])
            linked = maybe[100 * both >= percent * (sizes[one] + sizes[left[maybe]] - both)]
            if len(linked):
                new = left[linked]
                left = np.delete(left, linked)
                edges += [(int(nodes[one]), int(nodes[x])) for x in new]
                queue.extend(new.tolist())
    return edges


def shared(one: np.ndarray, others: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """How many hashes each of the others has in common with one; all are sorted and distinct."""
    out, first, total = np.zeros(len(others), np.int64), 0, 0
    for i, n in enumerate(sizes.tolist()):
        total += n
        if total >= SLICE or i + 1 == len(others):
            laid = np.concatenate(others[first : i + 1]).view(np.uint64)
            hit = one[np.minimum(np.searchsorted(one, laid), len(one) - 1)] == laid
            upto = np.concatenate([[0], np.cumsum(hit)])
            ends = np.cumsum(sizes[first : i + 1])
            out[first : i + 1] = upto[ends] - upto[ends - sizes[first : i + 1]]
            first, total = i + 1, 0
    return out


def sketches(documents: DataFrame, columns: list[str], m: int, k: int) -> DataFrame:
    """The columns with n_shingles, the set's digest (hi, lo) and its registers; an empty set has neither."""
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            n, parts, regs = [], [], []
            for text in batch.column("text"):
                h = shingles(text.as_py(), k)
                n.append(len(h))
                parts.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                regs.append(registers(h, m).tobytes() if len(h) else None)
            halves = [pa.array([int.from_bytes(p[i : i + 8], "little", signed=True) if p else None for p in parts], pa.int64()) for i in (0, 8)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(n, pa.int64()), *halves, pa.array(regs, pa.binary())], names=[*columns, "n_shingles", "hi", "lo", "regs"])

    return documents.select(*dict.fromkeys([*columns, "text"])).mapInArrow(apply, f"{schema}, n_shingles long, hi long, lo long, regs binary")


def stored(documents: DataFrame, needed: DataFrame, m: int, k: int) -> tuple[str, DataFrame]:
    """Writes the sets of the needed nodes (node, low, hi, lo) to files; the folder, and (node, file, at, n).

    A node's document is found by its doc_id, as a bitmap where ids allow it, so that texts aren't shuffled; those without
    a doc_id are all stored. A file has the name of the task attempt that wrote it, and rows of an attempt that isn't
    committed are dropped, so a task that runs again never changes what another one has read.
    """
    folder = new_path(documents.sparkSession, "sets")
    root = mounted(folder)
    os.makedirs(root, exist_ok=True)
    rows = marked(documents, needed.select(F.col("low").alias("doc_id"))).where("_trusted or doc_id is null").select("text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        name, at = f"sets-{TaskContext.get().taskAttemptId()}", 0
        with open(f"{root}/{name}", "wb") as out:
            for batch in batches:
                found = []
                for text in batch.column("text"):
                    if len(h := shingles(text.as_py(), k)):
                        out.write(registers(h, m).tobytes() + h.tobytes())
                        digest = np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), "<i8").tolist()
                        found.append((*digest, name, at, len(h)))
                        at += m + 8 * len(h)
                out.flush()
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], names=["hi", "lo", "file", "at", "n"])

    index = staged(rows.mapInArrow(write, "hi long, lo long, file string, at long, n long"), "set-files")
    # A set that stands in several rows may be stored several times; one place is enough.
    places = index.groupBy("hi", "lo").agg(F.min(F.struct("file", "at", "n")).alias("p")).join(needed, ["hi", "lo"])
    return folder, staged(places.select("node", "p.*"), "set-places")


def links(documents: DataFrame, distinct: DataFrame, percent: int, k: int, group: int = GROUP) -> DataFrame:
    """Edges (a, b) among the nodes of distinct (node, low, hi, lo, regs) that give the components of all links."""
    n_bands = bands(percent)
    m = n_bands * ROWS
    parts = F.explode(F.array(*[F.xxhash64(F.lit(i), F.substring("regs", i * ROWS + 1, ROWS)) for i in range(n_bands)]))
    keyed = distinct.select("node", parts.alias("key"))
    marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in (0, 1)]
    counts = keyed.groupBy("key").agg(F.count("*").alias("members"), *marks).where("members > 1")
    chosen = staged(counts.groupBy("members", "x0", "x1").agg(F.min("key").alias("key")).select("key", "members"), "sketch-keys")
    met = staged(keyed.join(chosen, "key"), "sketch-members")
    needed = staged(met.select("node").distinct().join(distinct, "node").select("node", "low", "hi", "lo"), "sketch-nodes")
    folder, places = stored(documents, needed, m, k)
    chunks = F.ceil(F.col("members") / group).cast("int")
    placed = met.join(places, "node").withColumn("c", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    few = placed.where(F.col("members") <= group).select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), "node", "file", "at", "n")
    # Each two chunks of a larger key are one task's work of bounded size; they cover what lies within a chunk, too.
    many = placed.where(F.col("members") > group).withColumn("o", F.explode(F.filter(F.sequence(F.lit(0), chunks - 1), lambda x: x != F.col("c"))))
    many = many.select("key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "node", "file", "at", "n")
    keys = ["key", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(folder, m)
        for rows in whole_groups(batches, keys):
            node, size, at = (rows.column(c).to_numpy() for c in ("node", "n", "at"))
            file, edges = rows.column("file").to_pylist(), []
            heads = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([(c := rows.column(x).to_numpy())[1:] != c[:-1] for x in keys])]))
            for a, z in zip(heads.tolist(), [*heads[1:].tolist(), len(node)], strict=True):
                regs, own = sets.load(file[a:z], at[a:z].tolist(), size[a:z].tolist())
                edges += forest(node[a:z], size[a:z], regs, own, percent)
            if edges:
                out = np.array(edges, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(out.min(1)), pa.array(out.max(1))], names=["a", "b"])

    # A fixed number: rows are small but their comparison isn't, so partitions aren't to be put together by size.
    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = few.unionByName(many).repartition(n, *keys).sortWithinPartitions(*keys, "node")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups: rows come sorted by the keys, and a batch's last group waits for the next batch."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = (pa.concat_tables([rest, table]) if rest is not None else table).combine_chunks()
        if not len(table):
            continue
        new = np.flatnonzero(np.logical_or.reduce([(c := table.column(x).to_numpy())[1:] != c[:-1] for x in keys]))
        cut = int(new[-1]) + 1 if len(new) else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and len(rest):
        yield rest


def near_duplicates(documents: DataFrame, columns: list[str] = ("doc_id",), percent: int = PERCENT, k: int = WORDS_PER_SHINGLE) -> DataFrame:
    """The columns of every document with n_shingles, component_id and kept (whether it is its component's document).

    Documents link where 100 * intersection >= percent * union of their distinct k-word shingles. component_id is the
    smallest doc_id that is reached, the own one included. Null, empty and blank texts have no shingles and link with
    nothing. Repeated rows stay and share a component; rows of one doc_id with different texts are compared each. A null
    doc_id counts as a component's smallest only where all are null; kept then is true. Texts of any length are hashed
    whole. An empty table gives an empty result; other columns aren't read. Shingles are compared by 64-bit hashes.
    """
    columns = list(dict.fromkeys(["doc_id", *columns]))
    n_bands = bands(percent)
    rows = staged(sketches(documents, columns, n_bands * ROWS, k), "sketches")
    equal = rows.where("hi is not null").groupBy("hi", "lo").agg(F.min("doc_id").alias("low"), F.min("regs").alias("regs"))
    distinct = staged(equal.withColumn("node", F.monotonically_increasing_id()), "distinct-sets")
    linked = components(links(documents, distinct, percent, k))
    grouped = staged(distinct.select("hi", "lo", "low", "node").join(linked, "node", "left").select("hi", "lo", "low", F.coalesce("component", "node").alias("group")), "set-groups")
    lowest = staged(grouped.groupBy("group").agg(F.min("low").alias("component_id")), "lowest")
    of = staged(grouped.join(lowest, "group").select("hi", "lo", "component_id"), "set-components")
    discard(grouped)
    alone = rows.where("hi is null").withColumn("component_id", F.col("doc_id"))  # apart: null keys would meet in one task
    found = rows.where("hi is not null").join(of, ["hi", "lo"]).unionByName(alone)
    return found.select(*columns, "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
