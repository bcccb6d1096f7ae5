"""Every registered query against its DuckDB oracle (sf0.001), like the driver's check."""
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from tidewatch.plans.registry import QUERIES as REGISTERED
from tidewatch.sources.bind import TABLES

SF = "/root/testdata/sf0.001"
# the library's own queries; those of optional parts have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k in REGISTERED}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in REGISTERED}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_documented():
    rows_only = {"dropout_stability", "baseline_percentiles", "geojson_scored"} | {k for k in QUERIES if k.startswith("stream_")}
    assert set(QUERIES) - set(ORACLE) <= rows_only


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, cols) == _digest(drows, dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "priority_band" in df.columns
