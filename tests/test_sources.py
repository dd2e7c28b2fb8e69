"""Readers of gauge files and SQLite tables, cubes in buckets, and series replaced in place."""

import os
import random
import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNotNull, StringContains
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rillflow.operators import cubes, forcing, tables
from rillflow.sources import hydat
from rillflow.sources.records import RecordReader, read_records, write_lines


def rdb_file(path, site, n, swapped=False, end="\n"):
    rng, names = random.Random(site), ["77_00060", "77_00060_cd"]
    head = ["# a comment, 00060", "#", "agency_cd\tsite_no\tdatetime\ttz_cd\t" + "\t".join(names[::-1] if swapped else names), "5s\t15s\t20d\t6s\t14n\t10s"]
    rows = [(str(site), f"2000-01-{i % 28 + 1:02d} 00:{i % 60:02d}", "EST", "" if i % 7 == 0 else str(rng.random()), "A" * (i % 3)) for i in range(n)]
    lines = ["USGS\t" + "\t".join([*r[:3], *(r[:2:-1] if swapped else r[3:])]) for r in rows]
    path.write_text(end.join([*head, *lines]) + ("" if n % 2 else end), newline="")
    return [tuple(x or None for x in r) for r in rows]


@pytest.mark.parametrize("size", [37, 200, 1 << 20])
def test_records(spark, tmp_path, size):
    """A file over several partitions gives the rows of one; heads of either order, line ends, empty cells, no rows."""
    want = rdb_file(tmp_path / "a.txt", 1, 41) + rdb_file(tmp_path / "b.txt", 2, 30, swapped=True, end="\r\n") + rdb_file(tmp_path / "c.txt", 3, 0)
    (tmp_path / "d.txt").write_text("")
    (tmp_path / ".hidden").write_text("x")
    df = read_records(spark, str(tmp_path), bytes_of_range=size)
    assert df.rdd.getNumPartitions() > (20 if size < 100 else 0)
    assert sorted((tuple(r)[1:] for r in df.collect()), key=str) == sorted(want, key=str)
    assert {os.path.basename(r.file) for r in df.select("file").distinct().collect()} == {"a.txt", "b.txt"}
    assert read_records(spark, f"{tmp_path}/nothing*").collect() == []


def test_csv_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("# Station: 1\n# CSV data starts at line 4\n#\n2000-01-01, 1.5 ,10,Final\n2000-01-02,,,\n")
    (tmp_path / "b.csv").write_text("# nothing said\n2000-01-01,1,2,x\n")
    for size in (10, 1000):
        rows = [tuple(r)[1:] for r in read_records(spark, f"{tmp_path}/*.csv", "wsc", bytes_of_range=size).orderBy("ts").collect()]
        assert rows == [("2000-01-01", "1.5", "10", "Final"), ("2000-01-02", None, None, None)]


def test_small_files_share_a_partition(tmp_path):
    for i in range(50):
        rdb_file(tmp_path / f"{i}.txt", i, 3)
    parts = RecordReader({"path": str(tmp_path), "bytes": "4000"}).partitions()
    assert 3 <= len(parts) < 15 and sum(len(p.ranges) for p in parts) == 50


@pytest.fixture
def flows(tmp_path):
    """Two files of stations s00..s19, five years each."""
    for f in range(2):
        with sqlite3.connect(tmp_path / f"{f}.sqlite") as db:
            db.execute("CREATE TABLE DLY_FLOWS (STATION_NUMBER TEXT, YEAR INTEGER, FLOW1 DOUBLE, FLOW_SYMBOL1 TEXT)")
            db.executemany("INSERT INTO DLY_FLOWS VALUES (?, ?, ?, ?)", [(f"s{i:02d}", 1990 + y, i + y / 10, None if y else "E") for i in range(f, 20, 2) for y in range(5)])
    return str(tmp_path)


def test_sqlite(spark, flows):
    """The whole table, pushed filters in the plan, and their rows."""
    df = hydat.read_sqlite(spark, flows, "DLY_FLOWS", "STATION_NUMBER", parts=3)
    assert df.dtypes == [("STATION_NUMBER", "string"), ("YEAR", "bigint"), ("FLOW1", "double"), ("FLOW_SYMBOL1", "string")]
    assert df.count() == 100 and df.rdd.getNumPartitions() >= 6
    some = df.where(F.col("STATION_NUMBER").isin("s03", "s04", "zz") & (F.col("YEAR") >= 1993))
    assert sorted((r.STATION_NUMBER, r.YEAR, r.FLOW1) for r in some.collect()) == [("s03", 1993, 3.3), ("s03", 1994, 3.4), ("s04", 1993, 4.3), ("s04", 1994, 4.4)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan sqlite_table" in plan and "Filter" not in plan.replace("RuntimeFilters", "")  # all of it was pushed
    assert df.where("FLOW_SYMBOL1 IS NULL").count() == 80 and df.where("STATION_NUMBER = 'zz'").count() == 0


def test_pushed_filters(flows):
    """Unlisted stations are in no range; what SQLite might decide otherwise is left to Spark."""
    schema = StructType([StructField("STATION_NUMBER", StringType()), StructField("YEAR", LongType())])
    reader = hydat.SqliteReader({"path": flows, "table": "DLY_FLOWS", "key": "STATION_NUMBER", "parts": "4"}, schema)
    left = list(reader.pushFilters([In(("STATION_NUMBER",), ("s03", "s15")), GreaterThanOrEqual(("YEAR",), 1994), IsNotNull(("YEAR",)), StringContains(("STATION_NUMBER",), "s"), EqualTo(("STATION_NUMBER",), 5)]))
    assert [type(f) for f in left] == [StringContains, EqualTo]
    spans = reader.partitions()
    assert sorted((s.low, s.high) for s in spans) == [("s03", "s03"), ("s15", "s15")]
    assert sorted(r for s in spans for b in reader.read(s) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)) == [("s03", 1994), ("s15", 1994)]


def test_written_sqlite(spark, tmp_path):
    df = spark.range(100).selectExpr("concat('s', id % 7) AS station", "id AS n", "id / 3 AS v").repartition(3)
    files = [r.file for r in hydat.write_sqlite(df, str(tmp_path / "db"), "t", "station").collect()]
    back = hydat.read_sqlite(spark, ",".join(files), "t", "station")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def exchanges_below_joins(plan):
    """Exchange operators under any join of a physical plan."""
    found, depth = [], None
    for line in plan.split("\n"):
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and at <= depth:
            depth = None
        if depth is None and "Join" in line:
            depth = at
        elif depth is not None and "Exchange" in line:
            found.append(line)
    return found


def test_cubes_lie_together(spark):
    """Three cubes are merged and remapped without an exchange below the joins, to the rows of plain joins."""
    cells = [(c, t) for c in range(40) for t in range(6)]
    make = lambda v, keep: spark.createDataFrame([(c, t, None if (c + t) % 9 == 0 else float(c * t + len(v))) for c, t in cells if keep(c, t)], f"cell int, ts int, {v} double")
    plain = [make("t", lambda c, t: True), make("pp", lambda c, t: c % 5 > 0), make("pet", lambda c, t: t != 3)]
    weights = spark.createDataFrame([(c, c % 3, 1.0 + c) for c in range(40)] + [(c, 9, 2.0) for c in range(0, 40, 4)], "cell int, hru int, w double")
    own, w = [cubes.bucketed(c, 4) for c in plain], cubes.bucketed(weights, 4, name="weights")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with cubes.by_bucket(spark):
            out = cubes.remapped(own, w, ["cell", "ts"], ["t", "pp", "pet"])
            got = sorted(map(tuple, out.collect()))
            plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and exchanges_below_joins(plan) == [] and "Exchange hashpartitioning(hru" in plan
        rows = plain[0].join(plain[1], ["cell", "ts"]).join(plain[2], ["cell", "ts"]).join(weights, "cell")
        mean = lambda v: F.sum(F.col("w") * F.col(v)) / F.sum(F.when(F.col(v).isNotNull(), F.col("w")))
        want = sorted(map(tuple, rows.groupBy("hru", "ts").agg(mean("t"), mean("pp"), mean("pet")).collect()))
        assert [r[:2] for r in got] == [r[:2] for r in want] and all(a == pytest.approx(b) for a, b in zip(got, want, strict=True))
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replaced_series(spark, tmp_path):
    """Only touched buckets are written anew; new stations come in; the same call again changes nothing."""
    path = str(tmp_path / "series")
    old = spark.range(300).selectExpr("concat('s', id % 30) AS site", "id AS day", "CAST(id AS double) AS q")
    tables.write_series(old, path, "site", 8)
    times = lambda: {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(path) if "bucket=" in d for f in fs if f.endswith(".parquet")}
    before = times()
    new = spark.createDataFrame([("s3", 1000, -1.0), ("s3", 1001, -2.0), ("new", 5, 0.5)], "site string, day long, q double")
    want = sorted([tuple(r) for r in old.collect() if r.site != "s3"] + [tuple(r) for r in new.collect()])
    for _ in range(2):
        touched = tables.replace_series(path, new, "site", 8)
        assert len(touched) <= 2
        assert sorted((r.site, r.day, r.q) for r in spark.read.parquet(path).collect()) == want
        after = times()
        kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
        assert kept and all(after[f] == before[f] for f in kept) and set(after) - kept


def test_written_lines(spark, tmp_path):
    """One file per name, its lines in order however rows lie, null lines left out; nothing else beside the files."""
    rows = spark.range(0, 3000, 1, 7).selectExpr("concat('file=', id % 50) AS file", "(id * 7919) % 3000 AS n", "CASE WHEN id % 11 > 0 THEN concat('é', (id * 7919) % 3000) END AS line")
    assert write_lines(rows, str(tmp_path / "out")) == 50
    want = {}
    for r in sorted(rows.collect(), key=lambda r: r.n):
        want.setdefault(r.file, []).extend([r.line] if r.line else [])
    got = {p.name: p.read_text(encoding="utf-8").splitlines() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert got == want and write_lines(rows.limit(0), str(tmp_path / "none")) == 0
    with pytest.raises(Exception, match="not a file name"):
        write_lines(rows.selectExpr("'../x' AS file", "n", "line"), str(tmp_path / "bad"))


def test_many_small_files(tmp_path):
    """Tens of thousands of small files make a few hundred tasks, and each byte is in one of them; a few files stay apart."""
    for i in range(3000):
        (tmp_path / f"{i}.rdb").write_text("x" * (3000 + i % 7))
    parts = RecordReader({"path": str(tmp_path), "bytes": "4000"}).partitions()
    assert len(parts) <= 300 and sorted(r for p in parts for r in p.ranges) == sorted((str(f), 0, f.stat().st_size) for f in tmp_path.iterdir())
    few = RecordReader({"path": f"{tmp_path}/1?.rdb", "bytes": "4000"}).partitions()
    assert len(few) == 10


def test_partners_are_counted(spark, monkeypatch):
    """Keys of one side, nulls and repeated keys, in several parts; no join that sorts both sides whole."""
    monkeypatch.setattr(forcing, "KEYS", 100)
    a = spark.range(0, 1000).selectExpr("id AS cell", "CAST(id % 7 AS int) AS day").union(spark.sql("SELECT 5L, 5")).union(spark.sql("SELECT NULL, 1"))
    b = spark.range(500, 1200).selectExpr("id AS cell", "CAST(id % 7 AS int) AS day").union(spark.sql("SELECT NULL, 1"))
    got = forcing.missing_partners(a, b, ["cell", "day"])
    want = [(i, i % 7, "left") for i in range(500)] + [(i, i % 7, "right") for i in range(1000, 1200)] + [(None, 1, "left"), (None, 1, "right")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_buckets_grow_with_cubes(spark, monkeypatch):
    """A bucket is sorted by one task, so larger cubes get more of them."""
    numbers, plain = [], cubes.bucketed
    monkeypatch.setattr(cubes, "ROWS", 50)
    monkeypatch.setattr(cubes, "bucketed", lambda df, buckets, *more, **named: numbers.append(buckets) or plain(df, buckets, *more, **named))
    cube = spark.range(0, 1000).selectExpr("id % 40 AS cell", "id DIV 40 AS day", "CAST(id AS double) AS t")
    weights = spark.range(0, 40).selectExpr("id % 3 AS hru", "id AS cell", "1.0 AS w")
    got = {(r.hru, r.day): r.t for r in cubes.remap_cubes([cube], weights, ["cell", "day"], ["t"], 4).collect()}
    want = {(h, d): d * 40 + sum(range(h, 40, 3)) / len(range(h, 40, 3)) for h in range(3) for d in range(25)}
    assert numbers == [20, 20] and got == pytest.approx(want)
