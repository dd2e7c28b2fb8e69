"""Benchmark decontamination: a prefix-filtered set join of item windows with document words.

A window is `size` consecutive item words (a shorter item is one window). Its elements are word shingles. All shingles
are ordered by how often the whole corpus holds them; a window that occurs in a document must bring its first, rarest
shingle along, so only that necessary prefix is joined with the documents' shingles. A candidate then has a fixed start
(the shingle's position less its offset in the window): the window must fit between the document's first and last word
(positional and length bounds), and its words must equal the document's (exact containment).

Neither the benchmark nor its index passes through the driver or is broadcast: shingles and prefixes are digest indexes
in the shared folder, which the tasks map into memory, so a task's memory doesn't grow with the benchmark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm import digests
from rillflow.llm.common import LOWER, UPPER, staged

WINDOW, SHINGLE = 10, 5
#: Words of the texts that are probed at once (of one text at least); shingles found that a counting task holds before
#: it adds them up; parsed prefixes that a judging task keeps.
PROBED, HELD, KEPT = 1 << 16, 1 << 20, 1 << 16

#: Bytes to word bytes: A-Z lower-cased; all that isn't 0-9, a-z or outside ASCII becomes a space.
_FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_P = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def numbers(ws: list[bytes]) -> np.ndarray:
    """A number of each word; equal words have equal ones, others nearly always not."""
    return np.fromiter(map(crc32, ws), np.uint64, len(ws))


def hashed(ids: np.ndarray, n: int) -> np.ndarray:
    """Digests of all n-word shingles of a row of word numbers."""
    h = np.full(max(len(ids) - n + 1, 0), n, np.uint64)
    for k in range(n):
        h = (h ^ ids[k : k + len(h)]) * _P
        h ^= h >> np.uint64(29)
    return h * _P


def grouped(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """The texts' words, some texts at a time."""
    group, size = [], 0
    for text in texts:
        group.append(words(text.as_py()))
        size += len(group[-1])
        if size >= PROBED:
            yield group
            group, size = [], 0
    if group:
        yield group


def probed(group: list[list[bytes]], lengths: list[int], keys: digests.Index) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, position, digest) arrays of the shingles of each length that the index has, one search for all texts."""
    ids = [numbers(ws) for ws in group]
    for n in lengths:
        parts = [hashed(x, n).view(np.int64) for x in ids]
        ends = np.cumsum([len(h) for h in parts])
        h = np.concatenate(parts)
        at = keys.found(h)
        text = np.searchsorted(ends, at, "right")
        yield text, at - (ends - [len(p) for p in parts])[text], h[at]


def window_items(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """window, items: each distinct window (its words joined by spaces) with the JSON list of the items that have it,
    as strings; a null stands for items without an id. Items without words have no window."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    found = benchmark.select(F.col("item_id").cast("string").alias("item"), F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0)).alias("ws"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - size + 1, F.lit(1)))
    one = found.where(F.size("ws") > 0).select("item", "ws", F.explode(starts).alias("at"))
    pairs = one.select(F.array_join(F.slice("ws", F.col("at"), size), " ").alias("window"), "item")
    ids = F.array_sort(F.collect_set("item"))
    nameless = F.array(F.lit(None).cast("string"))
    items = F.when(F.max(F.col("item").isNull()), F.concat(ids, nameless)).otherwise(ids)
    return pairs.groupBy("window").agg(F.to_json(items).alias("items"))


def shingles(windows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """window, n, offset, digest of each window's shingles; a window of fewer words is its own shingle of n words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for w in batch.column("window").to_pylist():
                ws = w.encode().split(b" ")
                n = min(size, len(ws))
                out += [(w, n, i, h) for i, h in enumerate(hashed(numbers(ws), n).view(np.int64).tolist())]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.int64()), strict=True)] if out else []
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names=["window", "n", "offset", "digest"])

    return windows.select("window").mapInArrow(cut, "window string, n int, offset int, digest long")


def frequencies(documents: DataFrame, index: str, lengths: list[int]) -> DataFrame:
    """digest, count: how often all texts hold each shingle of the index."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, n_held = digests.Index(index), [], 0

        def added() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["digest", "count"])

        for batch in batches:
            for group in grouped(batch.column("text")):
                for _, _, h in probed(group, lengths, keys):
                    held.append(h)
                    n_held += len(h)
                if n_held >= HELD:
                    yield added()
                    held, n_held = [], 0
        if n_held:
            yield added()

    return documents.select("text").mapInArrow(count, "digest long, count long").groupBy("digest").agg(F.sum("count").alias("count"))


def prefixes(benchmark: DataFrame, documents: DataFrame, size: int = WINDOW) -> tuple[str, list[int]]:
    """(index, lengths): the digest index of each window's rarest shingle, the first of equally rare ones, with the
    shingle's offset, the window and its items; and the numbers of words that shingles have (at most SHINGLE)."""
    windows = staged(window_items(benchmark, size), "benchmark-windows")
    of = staged(shingles(windows), "benchmark-shingles")
    lengths = sorted(r.n for r in of.select("n").distinct().collect())
    keys = of.select("digest").distinct().withColumn("entry", F.lit(""))
    seen = staged(frequencies(documents, digests.write(keys, keys.count(), "benchmark-keys"), lengths), "benchmark-counts")
    known = of.join(seen, "digest", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    first = known.groupBy("window").agg(F.min_by(F.struct("digest", "offset"), F.struct("count", "offset")).alias("x"))
    entry = F.concat_ws("\n", F.col("x.offset").cast("string"), "window", "items").alias("entry")
    return digests.write(first.join(windows, "window").select("x.digest", entry), windows.count(), "benchmark-prefixes"), lengths


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, columns: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The columns (all, unless listed) of every document with n_words, n_hit, items (sorted ids of found items), named
    after the prefix.

    A null or empty text has no words and no hits, and gives no window; texts of any length are judged whole. Items may
    have ids of any simple type; a null id stands in items as null, once, after the others. An empty benchmark hits
    nothing, an empty table gives an empty result. Equal items are all found; repeated documents are judged one by one.
    Columns of documents named as a result column are replaced.
    """
    made = [f"{prefix}{c}" for c in ("n_words", "n_hit", "items")]
    columns = [c for c in columns or documents.columns if c.lower() not in made]
    index, lengths = prefixes(benchmark, documents, size)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = digests.Index(index)

        @lru_cache(KEPT)
        def parsed(digest: int) -> list[tuple[int, list[bytes], list]]:
            parts = [e.split(b"\n") for e in keys.entries(digest)]
            return [(int(offset), window.split(b" "), json.loads(items)) for offset, window, items in parts]

        for batch in batches:
            n_words, n_hit, found = [], [], []
            for group in grouped(batch.column("text")):
                covered: list[np.ndarray | None] = [None] * len(group)
                items: list[set] = [set() for _ in group]
                for texts, positions, found_digests in probed(group, lengths, keys):
                    for i, p, digest in zip(texts.tolist(), positions.tolist(), found_digests.tolist(), strict=True):
                        ws = group[i]
                        for offset, window, some in parsed(digest):
                            start = p - offset
                            if start >= 0 and start + len(window) <= len(ws) and ws[start : start + len(window)] == window:
                                if covered[i] is None:
                                    covered[i] = np.zeros(len(ws), bool)
                                covered[i][start : start + len(window)] = True
                                items[i].update(some)
                n_words += [len(ws) for ws in group]
                n_hit += [0 if c is None else int(c.sum()) for c in covered]
                found += [list(x) for x in items]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(found, pa.list_(pa.string()))], names=[*columns, *made])

    rows = documents.select(*columns) if "text" in columns else documents.select(*columns, "text")
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns)
    judged = rows.mapInArrow(judge, f"{schema}, `{made[0]}` long, `{made[1]}` long, `{made[2]}` array<string>")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return judged.withColumn(made[2], F.array_sort(F.col(made[2]).cast(f"array<{kind}>")))
