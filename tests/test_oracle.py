"""Every registered query against its independent DuckDB oracle (small scale)."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import _digest
from stratum.oracle import ORACLE_SQL
from stratum.queries import QUERIES

from conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob.glob(os.path.join(SF_SMALL, "*.parquet")):
        name = os.path.basename(path)[:-len(".parquet")]
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 758
    assert "risk_score" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _digest(s_cols, s_rows)[0] == _digest(d_cols, d_rows)[0]
