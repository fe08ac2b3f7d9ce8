"""Driver contract and the DuckDB value oracle on the smallest scale."""
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from benefitlens.sources.tables import TABLES
from tests.conftest import SF0001

# keys whose checks are cheap; the ML keys are rows-only and slow
SKIP = {"io_write_splits", "io_read_split"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["region", "rank", "employee_id", "employment_type", "enrolled", "p", "capacity"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(k for k in E.oracle_sql() if k not in SKIP))
def test_value_oracle_sf0001(spark, duck, key):
    sdf = E.queries()[key](spark, SF0001)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert _digest(sdf.columns, srows) == _digest(ocols, orows)
