"""Contract enforcement and counts from footers."""

from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from regcurate import plans
from regcurate.operators.landing import land_register
from regcurate.operators.profile import contract_report
from regcurate.sinks.enforce import publish_enforced, read_rejects, with_broken_rules
from regcurate.sinks.versions import Published
from regcurate.sinks.writers import read_published, write_landed
from regcurate.sources.fixtures import register_view
from regcurate.sources.footers import footer_session, landed_counts
from regcurate.specs.curated import TABLES
from regcurate.specs.registers import REGISTERS


def test_both_parts_add_up(spark, tmp_path):
    root = str(tmp_path / "population")
    inputs = {"bef": register_view(spark, SF_SMALL, "bef").withColumn(
        "FOED_DAG", F.when(F.col("PNR") % 7 == 0, F.lit("1990")).otherwise(F.col("FOED_DAG")))}
    state = publish_enforced("population", inputs, root)
    clean, side = read_published(spark, "population", root)
    bad = read_rejects("population", Published(spark, root), state)
    whole = plans.build("population", inputs)
    assert bad.count() == side["rejected"]["size"] > 0
    assert clean.count() == side["size"] > 0
    assert rows(clean.unionByName(bad.select(clean.columns))) == rows(whole)
    told = {f"{r.column_name}:{r.rule}": r.violations
            for r in contract_report(whole, TABLES["population"]).collect()}
    assert side["rejected"]["rules"] == told and told["born_at:format"] > 0
    assert contract_report(clean, TABLES["population"]).where("violations > 0").count() == 0
    assert bad.where("size(broken_rules) = 0").count() == 0


def test_nulls_and_several_rules(spark):
    spec = TABLES["population"]
    names = spec.names
    base = dict.fromkeys(names, "x") | {"gender": "m", "born_at": "1990-01-01"}
    cases = [{}, {"person_id": None, "gender": "q"}, {"born_at": ""}, {"born_at": "yesterday"}]
    df = spark.createDataFrame([tuple((base | c)[n] for n in names) for c in cases],
                               ", ".join(f"{n} string" for n in names))
    got = [r.broken_rules for r in with_broken_rules(df, spec).collect()]
    assert got[0] == [] and "person_id:not_null" in got[1] and "gender:enum" in got[1]
    assert got[3] == ["born_at:format"]


def test_counts_come_from_the_footers(spark, tmp_path):
    path, spec = str(tmp_path / "bef"), REGISTERS["bef"]
    landed = land_register(register_view(spark, SF_SMALL, "bef"), spec)
    write_landed(landed, path)
    counts = landed_counts(spark, path, spec)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert "PushedGroupBy: [period, source_file]" in plan
    want = landed.groupBy("period", "source_file").agg(F.count(F.lit(1)).alias("rows"))
    assert rows(counts) == rows(want)
    assert rows(counts.join(want.drop("rows"), ["period", "source_file"])) == rows(want)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert footer_session(spark).conf.get("spark.sql.parquet.aggregatePushdown") == "true"
