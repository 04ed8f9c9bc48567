"""Plan shapes on landed Parquet tables (static broadcast off, so every
shuffle is visible): no shuffle for the narrow tables, one per side for the
diagnoses join, aggregate-then-join for first-file-wins, filters pushed to
the scan."""

import re

import pytest

from helpers import SF_SMALL
from regcurate import plans
from regcurate.operators.landing import land_register
from regcurate.sinks.writers import write_landed
from regcurate.sources.files import read_landed
from regcurate.sources.fixtures import register_view
from regcurate.specs.registers import REGISTERS

NEEDED = sorted({r for m in plans.PLANS.values() for r in m.INPUTS})


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stage1")
    out = {}
    for name in NEEDED:
        path = str(root / name)
        write_landed(land_register(register_view(spark, SF_SMALL, name), REGISTERS[name]), path)
        out[name] = read_landed(spark, path, REGISTERS[name])
    return out


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return len(re.findall(r"Exchange (hash|range|single|round)", _plan(df)))


@pytest.mark.parametrize("name", ["income", "family_income", "education", "employment",
                                  "deaths", "prescriptions"])
def test_narrow_tables_do_not_shuffle(spark, landed, no_broadcast, name):
    df = plans.build(name, landed)
    assert _exchanges(df) == 0
    assert "BroadcastExchange" not in _plan(df)


def test_key_filter_reaches_the_scan(spark, landed, no_broadcast):
    plan = _plan(plans.build("income", landed))
    assert re.search(r"PushedFilters: \[.*IsNotNull\(PNR\).*Not\(EqualTo\(PNR,\)\)", plan)
    # only the needed columns are read (ALDER_ULT_INK is not curated)
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert "PNR" in scanned and "ALDER_ULT_INK" not in scanned


def test_diagnoses_is_one_join_with_one_shuffle_per_side(spark, landed, no_broadcast):
    df = plans.build("diagnoses", landed)
    plan = _plan(df)
    assert plan.count("SortMergeJoin") == 1
    assert _exchanges(df) == 2


def test_diagnoses_sorts_by_the_record_first(spark, landed, no_broadcast):
    """The register, first, is one value in most comparisons of a sort."""
    plan = _plan(plans.build("diagnoses", landed))
    assert re.search(r"SortMergeJoin \[record_id", plan)


def test_population_first_file_wins_shape(spark, landed, no_broadcast):
    plan = _plan(plans.build("population", landed))
    assert plan.count("SortMergeJoin") == 1
    assert "partial_min" in plan and "HashAggregate" in plan
    assert "SortAggregate" not in plan and "rank(" not in plan
    assert _exchanges(plans.population.build_window(landed["bef"])) == 1
    assert _exchanges(plans.population.build_unique(landed["bef"])) == 1


@pytest.mark.parametrize("name", ["population", "diagnoses"])
def test_building_a_plan_runs_nothing(spark, landed, name):
    spark.sparkContext.setJobGroup(f"build-{name}", "")
    plans.build(name, landed)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    spark.sparkContext.setJobGroup("", "")


def test_counts_of_diagnoses_do_not_join(spark, no_broadcast):
    from regcurate.catalog import QUERIES
    for name in ("diagnoses_by_register", "diagnoses_pair_profile", "count_by_patient_kind",
                 "contract_report", "coverage"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", plan)
        assert not [j for j in joins if "record_id" in j], name
