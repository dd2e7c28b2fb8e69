"""A table sorted by a 64-bit key, as Arrow files in the shared folder that tasks map into memory.

Each range of keys is one file. A file has the name of the task attempt that wrote it, and only what committed attempts
report is read, so a task that runs again never changes what another one reads.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rillflow.llm.common import mounted, new_path, staged

#: Rows of a file, about.
ROWS = 1 << 21


def write(rows: DataFrame, key: str, n: int, name: str) -> tuple[str, list[tuple[int, str]]]:
    """Writes about n rows by key; the folder, and (first key, file) of each file that has rows. Equal keys are in one file."""
    folder = new_path(rows.sparkSession, name)
    root = mounted(folder)
    os.makedirs(root, exist_ok=True)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kept = [b for b in batches if b.num_rows]
        if kept:
            table, file = pa.Table.from_batches(kept).combine_chunks(), f"{name}-{TaskContext.get().taskAttemptId()}"
            with pa.OSFile(f"{root}/{file}", "wb") as sink, pa.ipc.new_file(sink, table.schema) as out:
                out.write_table(table)
            yield pa.RecordBatch.from_pydict({"first": [table.column(key)[0].as_py()], "file": [file]})

    ordered = rows.repartitionByRange(n // ROWS + 1, key).sortWithinPartitions(key)
    return folder, sorted(tuple(r) for r in staged(ordered.mapInArrow(one, "first long, file string"), f"{name}-manifest").collect())  # one row per file


class SortedFiles:
    """The files of one table, mapped into memory."""

    def __init__(self, written: tuple[str, list[tuple[int, str]]], key: str):
        folder, files = written
        self.first = np.array([f[0] for f in files], np.int64)
        self.tables = [pa.ipc.open_file(pa.memory_map(f"{mounted(folder)}/{name}")).read_all().combine_chunks() for _, name in files]
        self.keys = [t.column(key).to_numpy() for t in self.tables]

    def shards(self, ordered: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray, int, int]]:
        """For sorted keys: the file's table and keys that may hold keys x to z."""
        cuts = [0, *np.searchsorted(ordered, self.first[1:]).tolist(), len(ordered)]
        for table, keys, x, z in zip(self.tables, self.keys, cuts, cuts[1:], strict=False):
            if z > x:
                yield table, keys, x, z

    def numbers(self, codes: np.ndarray, column: str) -> np.ndarray:
        """The column's value for each code, -1 where there is none. Keys are distinct."""
        distinct, back = np.unique(codes, return_inverse=True)
        out = np.full(len(distinct), -1, np.int64)
        for table, keys, x, z in self.shards(distinct):
            at = np.minimum(np.searchsorted(keys, distinct[x:z]), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == distinct[x:z])
            out[x + hit] = table.column(column).to_numpy()[at[hit]]
        return out[back]
