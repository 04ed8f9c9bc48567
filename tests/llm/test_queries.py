"""Training-data queries with an oracle, against DuckDB."""

import duckdb
import pytest

from regcurate.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == \
        sorted(map(str, res.fetchall()))
