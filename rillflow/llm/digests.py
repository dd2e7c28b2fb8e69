"""A sorted array of 64-bit digests with a string each, in flat files that readers map into memory.

Rows are range-partitioned by digest; each partition writes a shard to the shared folder: sorted keys, 64-bit offsets,
the strings, and a bitmap of the keys' low bits. Readers touch only the pages that their searches need, so the memory
of a task doesn't grow with the index; the operating system shares the pages among the workers of a machine.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import mounted, new_path

#: Keys in a shard, about; and bits of the bitmap for each key, at least.
SHARD_KEYS, BITS_PER_KEY = 4_000_000, 16


def write(rows: DataFrame, n: int, name: str = "digests") -> str:
    """Writes (digest, entry) rows, about n of them, and returns the index folder. Rows are kept as they are: equal
    digests stand side by side. Files appear by rename, so a task that runs again leaves one whole copy."""
    folder = new_path(rows.sparkSession, name)
    root = mounted(folder)
    os.makedirs(root, exist_ok=True)
    ordered = rows.select("digest", "entry").repartitionByRange(n // SHARD_KEYS + 1, "digest").sortWithinPartitions("digest", "entry")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        base = f"{root}/shard-{context.partitionId():05d}"
        temp, n, at, longest = f"{base}.{context.taskAttemptId()}", 0, 0, 0
        with open(f"{temp}.keys", "wb") as keys, open(f"{temp}.offsets", "wb") as offsets, open(f"{temp}.strings", "wb") as strings:
            offsets.write(np.zeros(1, "<i8").tobytes())
            for batch in batches:
                data = [x.encode() for x in batch.column("entry").to_pylist()]
                sizes = np.array([len(x) for x in data], "<i8")
                ends = at + np.cumsum(sizes)
                keys.write(batch.column("digest").to_numpy().astype("<i8").tobytes())
                offsets.write(ends.astype("<i8").tobytes())
                strings.write(b"".join(data))
                if data:
                    n, at, longest = n + len(data), int(ends[-1]), max(longest, int(sizes.max()))
        bits = np.zeros(1 << max(14, (n * BITS_PER_KEY).bit_length() - 3), np.uint8)
        written = np.memmap(f"{temp}.keys", "<u8", "r") if n else np.zeros(0, "<u8")
        for i in range(0, n, 1 << 20):
            low = written[i : i + (1 << 20)] & np.uint64(8 * len(bits) - 1)
            np.bitwise_or.at(bits, (low >> np.uint64(3)).astype(np.int64), np.left_shift(1, low & np.uint64(7)).astype(np.uint8))
        bits.tofile(f"{temp}.bits")
        np.array([longest], "<i8").tofile(f"{temp}.longest")
        for kind in ("strings", "offsets", "bits", "longest", "keys"):
            os.replace(f"{temp}.{kind}", f"{base}.{kind}")
        yield pa.RecordBatch.from_pydict({"n": [n]})

    ordered.mapInArrow(shard, "n long").agg(F.sum("n")).collect()
    return folder


class Index:
    """The shards of one index, memory-mapped, in the order of their keys."""

    def __init__(self, folder: str):
        root, shards, self.longest = mounted(folder), [], 0
        for name in sorted(x[:-5] for x in os.listdir(root) if x.endswith(".keys") and x.count(".") == 1):
            if os.path.getsize(f"{root}/{name}.keys"):
                self.longest = max(self.longest, int(np.fromfile(f"{root}/{name}.longest", "<i8")[0]))
                keys, offsets, bits = (np.memmap(f"{root}/{name}.{kind}", dtype, "r") for kind, dtype in (("keys", "<i8"), ("offsets", "<i8"), ("bits", np.uint8)))
                size = os.path.getsize(f"{root}/{name}.strings")
                shards.append((keys, offsets, bits, np.memmap(f"{root}/{name}.strings", np.uint8, "r") if size else np.zeros(0, np.uint8)))
        self.shards = sorted(shards, key=lambda s: s[0][0])
        self.first = np.array([s[0][0] for s in self.shards], np.int64)

    def found(self, digests: np.ndarray) -> np.ndarray:
        """The places, in order, of the signed digests that are keys: the bitmap first, then a binary search. Digests are
        dealt to the shards by their ranges, so many shards cost little if many digests are asked at once."""
        if not len(self.shards) or not len(digests):
            return np.zeros(0, np.int64)
        if len(self.shards) == 1:
            return self._in(0, digests)
        order = np.argsort(digests, kind="stable")
        ends = [*np.searchsorted(digests[order], self.first[1:]).tolist(), len(order)]
        hits, at = [], 0
        for i, end in enumerate(ends):
            if end > at:
                own = order[at:end]
                hits.append(own[self._in(i, digests[own])])
            at = end
        return np.sort(np.concatenate(hits))

    def _in(self, shard: int, digests: np.ndarray) -> np.ndarray:
        keys, _, bits, _ = self.shards[shard]
        low = digests.view(np.uint64) & np.uint64(8 * len(bits) - 1)
        at = np.flatnonzero((bits[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1)
        p = np.minimum(np.searchsorted(keys, digests[at]), len(keys) - 1)
        return at[keys[p] == digests[at]]

    def entries(self, digest: int) -> Iterator[bytes]:
        """The strings stored with a digest; equal ones are in one shard."""
        i = int(np.searchsorted(self.first, np.int64(digest), "right")) - 1
        if i < 0:
            return
        keys, offsets, _, strings = self.shards[i]
        p = int(np.searchsorted(keys, np.int64(digest)))
        while p < len(keys) and keys[p] == digest:
            yield strings[offsets[p] : offsets[p + 1]].tobytes()
            p += 1
