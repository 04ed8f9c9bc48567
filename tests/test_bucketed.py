"""Joins of bucketed registers."""

import pytest

from helpers import SF_SMALL, rows
from regcurate import plans
from regcurate.operators.landing import land_register
from regcurate.sinks import bucketed
from regcurate.sources.fixtures import register_view
from regcurate.specs.registers import REGISTERS


def _tables(spark, tmp_path, landed, buckets):
    tables = {}
    for register, df in landed.items():
        name, path = f"{tmp_path.name.replace('-', '_')}_{register}", str(tmp_path / register)
        bucketed.write_bucketed(df, register, name, path, buckets)
        tables[register] = (name, path)
    return tables


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def landed(spark):
    return {r: land_register(register_view(spark, SF_SMALL, r), REGISTERS[r])
            for r in plans.diagnoses.INPUTS}


def test_no_exchange_below_the_joins(spark, tmp_path, landed, monkeypatch):
    monkeypatch.setattr(bucketed, "_session", _no_broadcast(bucketed._session))
    tables = _tables(spark, tmp_path, landed, 4)
    got = bucketed.build(spark, tables, 4)
    assert rows(got) == rows(plans.diagnoses.build(landed))
    plan = _plan(got)
    assert plan.count("SortMergeJoin") >= 5 and "Exchange" not in plan
    one = bucketed.build(spark, {r: tables[r] for r in ("lpr_adm", "lpr_diag")}, 4)
    year = spark.table(tables["lpr_adm"][0]).where("period = '1995'")
    assert "PartitionFilters: [isnotnull(period" in _plan(year) and one.count() > 0


def test_a_hot_record_is_joined_by_a_shuffle(spark, tmp_path, landed, monkeypatch):
    monkeypatch.setattr(bucketed, "_session", _no_broadcast(bucketed._session))
    hot = {"psyk_adm": landed["psyk_adm"].limit(50), "psyk_diag": landed["psyk_diag"]}
    one = hot["psyk_diag"].limit(1)
    for _ in range(10):
        one = one.unionByName(one)
    hot["psyk_diag"] = hot["psyk_diag"].limit(100).unionByName(one).cache()
    hot["psyk_adm"] = hot["psyk_adm"].cache()
    tables = _tables(spark, tmp_path, hot, 8)
    sizes = bucketed.bucket_sizes(spark, tables["psyk_diag"][1])
    assert sum(sizes.values()) > 0 and bucketed.even(sizes, 8)
    got = bucketed.build(spark, tables, 8, large=1)
    if not bucketed.even(sizes, 8, 1):
        assert "Exchange" in _plan(got)
    assert rows(got) == rows(plans.diagnoses.build(hot))
    assert not bucketed.even({0: 1000, 1: 10, 2: 10, 3: 10, 4: 10}, 8, 1)
    assert bucketed.even({k: 1000 for k in range(8)}, 8, 1)


def _no_broadcast(session):
    def own(spark, on):
        s = session(spark, on)
        s.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        return s
    return own


def test_buckets_grow_with_the_largest_register(spark, landed):
    tens = bucketed.bucket_count(landed.values(), 1, share=10)      # tens of bytes
    assert 4_000 < tens < bucketed.MOST == bucketed.bucket_count(landed.values(), 1, share=1)
    assert abs(bucketed.bucket_count(landed.values(), 4, tens // 4) - 40) <= 1
    assert bucketed.bucket_count(landed.values(), 64, tens // 4) == 64
    assert bucketed.bucket_count([], 4) == 4
