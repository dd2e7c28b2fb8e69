"""Every registered query of the library against its SQL on the smallest tables."""

import duckdb
import numpy as np
import pytest

from rillflow.plans import catalog

SF = "/root/testdata/sf0.001"
#: Larger tables for what has only a few rows on the smallest ones.
LARGER = "/root/testdata/sf0.01"
AT_LARGER = sorted(n for n in catalog.ORACLE_SQL if n.split("_")[0] in {"j3", "j5", "j7", "j8", "j11", "j12", "j14"})
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


def rows(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif df[c].dtype.kind == "f" or str(df[c].dtype) == "Float64":
            df[c] = df[c].astype(float)
        elif df[c].dtype == object:
            df[c] = df[c].map(lambda v: "" if v is None or v != v else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def tables_of(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def duck():
    return {folder: tables_of(folder) for folder in (SF, LARGER)}


@pytest.mark.parametrize(("name", "folder"), [(n, SF) for n in sorted(catalog.ORACLE_SQL)] + [(n, LARGER) for n in AT_LARGER])
def test_query(spark, duck, name, folder):
    mine, theirs = rows(catalog.QUERIES[name](spark, folder).toPandas()), rows(duck[folder].sql(catalog.ORACLE_SQL[name]).df())
    assert list(mine.columns) == list(theirs.columns) and len(mine) == len(theirs)
    for c in mine.columns:
        if mine[c].dtype.kind in "fiub":
            np.testing.assert_allclose(mine[c].astype(float), theirs[c].astype(float), rtol=1e-7, atol=2e-6, err_msg=c)
        else:
            assert (mine[c] == theirs[c]).all(), c


def test_entry_needs_no_extras():
    """The library itself imports nothing from the training-data subpackage."""
    import pathlib

    root = pathlib.Path(catalog.__file__).parents[1]
    for p in root.rglob("*.py"):
        assert "llm" in p.parts or "rillflow.llm" not in p.read_text(), p
