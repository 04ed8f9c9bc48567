"""Every catalogue query against its DuckDB oracle on the sf0.001 tables."""

import hashlib
import json
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import SF_SMALL

# the registers' catalogue; optional subpackages test their own queries
QUERIES = {k: v for k, v in entry.queries().items() if k in entry.QUERIES}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in entry.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("orders", "lineitem", "customer"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([None if r[i] is None else str(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["person_id", "record_id"]
    assert df.count() > 0
    assert Path(SF_SMALL).exists()
