"""Gauge files as a data source: `spark.read.format("gauge_records")`, in partitions of files and byte ranges.

Options: path (files, folders or patterns, separated by commas, on a mounted folder), kind (rdb or wsc), param (rdb: the
parameter code) and bytes (of a range). A range takes the lines that start inside it. What the head of a file says (the
columns of RDB text, the first data line of self-describing CSV) is read from its first lines by whoever reads a range.
"""

from __future__ import annotations

import glob
import itertools
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, lines of a batch, partitions up to which small ranges are spread out, and folders of written files.
RANGE, LINES, SPREAD, FOLDERS = 64 << 20, 8192, 256, 256
SCHEMAS = {"rdb": "file string, site string, datetime string, tz_cd string, obs string, obs_cd string", "wsc": "file string, ts string, value string, grade string, approval string"}


@dataclass
class Pieces(InputPartition):
    """(file, start, end) of byte ranges: one of a large file, or many small files."""

    ranges: list[tuple[str, int, int]]

    def __post_init__(self) -> None:
        super().__init__(None)


def files_of(path: str) -> list[str]:
    """The files that the comma-separated files, folders and patterns name, hidden ones left out."""
    found = []
    for one in path.split(","):
        one = one.strip().removeprefix("file://").removeprefix("file:")
        for name in sorted(glob.glob(one)):
            found += sorted(f for f in glob.glob(f"{name}/*") if os.path.isfile(f)) if os.path.isdir(name) else [name]
    return [f for f in found if os.path.basename(f)[:1] not in "._"]


def rdb_head(lines: Iterator[bytes], param: str) -> tuple[int, list[int | None]]:
    """(bytes of the head, the places of site, time, zone, value and code): comments, the names, and the formats."""
    size, names = 0, None
    for line in lines:
        text = line.decode(errors="replace").rstrip("\r\n")
        if names is not None and not text.startswith("#") and text.strip():
            first = text.split("\t")[0]
            size += len(line) if re.fullmatch(r"\d+[sdn]", first) else 0
            break
        size += len(line)
        if names is None and not text.startswith("#") and text.strip():
            names = text.split("\t")
    at = lambda pattern: next((i for i, n in enumerate(names or []) if re.search(pattern, n)), None)
    return size, [at(p) for p in ("^site_no$", "^datetime$", "^tz_cd$", rf"_{param}(_00003)?$", rf"_{param}(_00003)?_cd$")]


def wsc_head(lines: Iterator[bytes]) -> tuple[int, list[int | None]]:
    """(bytes before the first data line, which the head names by its number; a file that doesn't has no data)."""
    size, start = 0, None
    for n, line in enumerate(lines, 1):
        found = re.search(rb"(?i)data starts at line (\d+)", line)
        start = int(found[1]) if found else start
        if start is not None and n >= start:
            return size, [0, 1, 2, 3]
        size += len(line)
    return size, []


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.kind, self.param = options.get("kind", "rdb"), options.get("param", "00060")
        self.path, self.bytes = options["path"], int(options.get("bytes", RANGE))
        self.names = [c.split()[0] for c in SCHEMAS[self.kind].split(", ")]

    def partitions(self) -> list[Pieces]:
        """Ranges one after another, up to a range's bytes each; where that makes more than SPREAD partitions, as many
        ranges as SPREAD needs, up to RANGE bytes: small files would take a task each few of them."""
        lengths = {file: os.path.getsize(file) for file in files_of(self.path)}
        most = max(self.bytes, min(RANGE, -(-sum(lengths.values()) // SPREAD)))
        out, size = [Pieces([])], 0
        for file, length in lengths.items():
            for start in range(0, length, self.bytes):
                end = min(start + self.bytes, length)
                if out[-1].ranges and size + end - start > most:
                    out.append(Pieces([]))
                    size = 0
                out[-1].ranges.append((file, start, end))
                size += end - start
        return out

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        for piece in partition.ranges:
            yield from self.lines(*piece)

    def lines(self, file: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
        with open(file, "rb") as f:
            size, places = rdb_head(f, self.param) if self.kind == "rdb" else wsc_head(f)
            # A line belongs to the range that its first byte is in.
            at = max(start, size)
            if at > size:
                f.seek(at - 1)
                at += len(f.readline()) - 1
            else:
                f.seek(at)
            rows: list[list] = []
            while at < end and (line := f.readline()):
                at += len(line)
                text = line.decode(errors="replace").rstrip("\r\n")
                if text.strip() and not (self.kind == "rdb" and text.startswith("#")):
                    cells = text.split("\t" if self.kind == "rdb" else ",")
                    if self.kind == "wsc":
                        cells = [c.strip() for c in cells]
                    rows.append([cells[i] or None if i is not None and i < len(cells) else None for i in places])
                if len(rows) >= LINES:
                    yield self.batch(file, rows)
                    rows = []
            if rows and places:
                yield self.batch(file, rows)

    def batch(self, file: str, rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), *(pa.array(c, pa.string()) for c in zip(*rows, strict=True))], names=self.names)


class GaugeRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gauge_records"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "rdb")]

    def reader(self, schema) -> RecordReader:
        return RecordReader(dict(self.options))


def read_records(spark: SparkSession, path: str, kind: str = "rdb", param: str = "00060", bytes_of_range: int = RANGE) -> DataFrame:
    """The records of gauge files, all text: file, site, datetime, tz_cd, obs, obs_cd (rdb), or file, ts, value, grade,
    approval (wsc). Cells that are empty or that a file's head doesn't name are null."""
    spark.dataSource.register(GaugeRecords)
    return spark.read.format("gauge_records").option("path", path).option("kind", kind).option("param", param).option("bytes", str(bytes_of_range)).load()


def write_lines(rows: DataFrame, path: str) -> int:
    """Writes lines (file, n, line) as one text file per file name, in the order of n, to folders under a path of a mounted
    folder; the number of files. A null line is left out. A file appears whole, by rename, so a task that runs again
    leaves one copy; it is written as its lines come, however many they are."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out, number = None, None, 0
        for batch in batches:
            pairs = zip(batch.column("file").to_pylist(), batch.column("line").to_pylist(), strict=True)
            for file, some in itertools.groupby(pairs, lambda p: p[0]):
                if out is None or file != at:
                    if out is not None:
                        put(out, at)
                    if not file or "/" in file or file[0] in "._":
                        raise ValueError(f"not a file name: {file!r}")
                    at, number = file, number + 1
                    os.makedirs(folder(file), exist_ok=True)
                    out = open(f"{folder(file)}/.{uuid.uuid4().hex}", "w", encoding="utf-8", newline="")
                out.writelines(f"{line}\n" for _, line in some if line is not None)
        if out is not None:
            put(out, at)
        yield pa.RecordBatch.from_arrays([pa.array([number])], names=["files"])

    def folder(file: str) -> str:
        return f"{path}/{zlib.crc32(file.encode()) % FOLDERS:03d}"

    def put(out, file: str) -> None:
        out.close()
        os.replace(out.name, f"{folder(file)}/{file}")

    ordered = rows.select("file", "n", "line").repartition("file").sortWithinPartitions("file", "n")
    return ordered.mapInArrow(write, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
