"""Every detection query against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tesserae.plans import catalog, layers  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else repr(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    if name not in catalog.ORACLE_SQL:
        assert df.count() > 0
        return
    rel = db.sql(catalog.ORACLE_SQL[name])
    assert columns == sorted(rel.columns)
    order = [rel.columns.index(c) for c in columns]
    own = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    assert own == sorted(tuple(plain(r[k]) for k in order) for r in rel.fetchall())
