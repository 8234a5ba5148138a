"""Every registered query against its DuckDB oracle on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of

QUERIES = {name: fn for name, fn in entry.queries().items() if name in entry.REGISTRY}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SF_SMALL) / f"{t}.parquet"
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = rows_of([tuple(r[c] for c in cols) for r in df.collect()])
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = {c: i for i, c in enumerate(dcols)}
    want = rows_of([tuple(r[idx[c]] for c in cols) for r in rel.fetchall()])
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns
