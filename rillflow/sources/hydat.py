"""A table of SQLite files as a data source: `spark.read.format("sqlite_table")`, by ranges of a key, filters pushed down.

Options: path (files, folders or patterns on a mounted folder), table, key (a text or whole-number column) and parts (a
file's ranges). Comparisons of columns with values, lists of values and null tests go into each range's query, so stations
that aren't asked for are never read; only what SQLite can't decide the same way is left to Spark.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from rillflow.sources.records import files_of

#: Ranges of a file, and rows of a batch.
PARTS, ROWS = 16, 8192
_KINDS = {"INT": pa.int64(), "TEX": pa.string(), "CHA": pa.string(), "VAR": pa.string(), "REA": pa.float64(), "DOU": pa.float64(), "FLO": pa.float64()}
_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass
class Span(InputPartition):
    file: str
    low: object
    high: object

    def __post_init__(self) -> None:
        super().__init__(None)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def opened(file: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{file}?mode=ro", uri=True)


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.key, self.parts = options["path"], options["table"], options["key"], int(options.get("parts", PARTS))
        self.schema = schema
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes what SQLite decides as Spark does: numbers and binary text against values of their kind."""
        kinds = {f.name: f.dataType.simpleString() for f in self.schema}
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            fits = lambda v, c=column: isinstance(v, str) if kinds.get(c) == "string" else isinstance(v, (int, float)) and not isinstance(v, bool)
            if type(f) in _SIGNS and column in kinds and fits(f.value):
                self.where.append(f"{quoted(column)} {_SIGNS[type(f)]} ?")
                self.values.append(f.value)
            elif isinstance(f, In) and column in kinds and all(map(fits, f.value)) and len(f.value) < 30_000:
                self.where.append(f"{quoted(column)} IN ({', '.join('?' * len(f.value))})")
                self.values += f.value
            elif isinstance(f, IsNotNull) and column in kinds:
                self.where.append(f"{quoted(column)} IS NOT NULL")
            else:
                yield f

    def partitions(self) -> list[Span]:
        """Ranges of the keys that the filters leave, with about as many keys each."""
        out, key = [], quoted(self.key)
        for file in files_of(self.path):
            with opened(file) as db:
                keys = [r[0] for r in db.execute(f"SELECT DISTINCT {key} FROM {quoted(self.table)} WHERE {' AND '.join([f'{key} IS NOT NULL', *self.where])} ORDER BY {key}", self.values)]
            step = max(1, -(-len(keys) // self.parts))
            out += [Span(file, keys[i], keys[min(i + step, len(keys)) - 1]) for i in range(0, len(keys), step)]
        return out or [Span("", None, None)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        names, shape = [f.name for f in self.schema], to_arrow_schema(self.schema)
        where = " AND ".join([f"{quoted(self.key)} BETWEEN ? AND ?", *self.where])
        with opened(partition.file) as db:
            rows = db.execute(f"SELECT {', '.join(map(quoted, names))} FROM {quoted(self.table)} WHERE {where}", [partition.low, partition.high, *self.values])
            while some := rows.fetchmany(ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*some, strict=True), shape, strict=True)], schema=shape)


class SqliteTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> StructType:
        files = files_of(self.options["path"])
        if not files:
            raise ValueError(f"no file at {self.options['path']}")
        with opened(files[0]) as db:
            columns = list(db.execute(f"PRAGMA table_info({quoted(self.options['table'])})"))
        return from_arrow_schema(pa.schema([(c[1], _KINDS.get(c[2].upper()[:3], pa.string())) for c in columns]))

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(dict(self.options), schema)


def read_sqlite(spark: SparkSession, path: str, table: str, key: str, parts: int = PARTS) -> DataFrame:
    """The rows of a table with a non-null key. Filters on it go into the queries (`spark.sql.python.filterPushdown`)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SqliteTable)
    return spark.read.format("sqlite_table").option("path", path).option("table", table).option("key", key).option("parts", str(parts)).load()


def write_sqlite(df: DataFrame, folder: str, table: str, key: str) -> DataFrame:
    """Writes each partition as a SQLite file with an index on the key into a mounted folder; (file, rows) of each. A file
    has the name of its task attempt and appears by rename; only the files that this table names, once it is written, are
    whole and committed."""
    names = df.columns
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "string": "TEXT"}
    columns = ", ".join(f"{quoted(f.name)} {kinds[f.dataType.simpleString()]}" for f in df.schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        os.makedirs(folder, exist_ok=True)
        file, n = f"{folder}/part-{TaskContext.get().taskAttemptId()}.sqlite", 0
        temp = f"{folder}/.{os.path.basename(file)}"
        with sqlite3.connect(temp) as db:
            db.execute(f"CREATE TABLE {quoted(table)} ({columns})")
            for batch in batches:
                db.executemany(f"INSERT INTO {quoted(table)} VALUES ({', '.join('?' * len(names))})", zip(*(c.to_pylist() for c in batch.columns), strict=True))
                n += batch.num_rows
            db.execute(f"CREATE INDEX {quoted('by_' + key)} ON {quoted(table)} ({quoted(key)})")
        db.close()
        os.replace(temp, file)
        yield pa.RecordBatch.from_pydict({"file": [file], "rows": [n]})

    return df.mapInArrow(write, "file string, rows long")
