"""Profiles on small literal tables."""

import random

import pyarrow.parquet as pq
from helpers import rows
from pyspark.sql import functions as F

from regcurate.operators.profile import (contract_report, coverage_of_parts, coverage_row,
                                         file_inventory, group_count, joined_contract_report,
                                         out_of_order, reconcile_counts, rows_per_file)
from regcurate.specs.curated import TABLES


def _pop(spark, data):
    cols = TABLES["population"].names
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))


def test_contract_report_counts_each_rule(spark):
    data = [
        ("1", "m", "1970-01-01", "5", "2", "3", "9", "bef1985.sas7bdat"),
        ("2", "x", "1970/01/01", "5", "2", "3", "9", "bef1985.sas7bdat"),   # enum, format
        ("3", None, "", "5", None, "3", "9", "bef1985.sas7bdat"),           # nulls/empties
    ]
    got = {(r.column_name, r.rule): r.violations
           for r in contract_report(_pop(spark, data), TABLES["population"]).collect()}
    assert got[("gender", "enum")] == 1          # null is not an enum violation
    assert got[("gender", "not_null")] == 1
    assert got[("born_at", "format")] == 1       # empty counts as missing, not as format
    assert got[("born_at", "not_null")] == 1
    assert got[("mother_id", "not_null")] == 1
    assert got[("person_id", "not_null")] == 0


def test_undeclared_category_is_flagged(spark):
    from regcurate.plans import prescriptions
    from regcurate.specs.registers import REGISTERS
    cols = list(REGISTERS["lmdb"].columns) + ["source_file"]
    df = spark.createDataFrame(
        [("p",) + (atc,) + ("x",) * (len(cols) - 3) + ("lmdb2001.sas7bdat",)
         for atc in ("N02", "Q01", None, "")], ", ".join(f"{c} string" for c in cols))
    report = contract_report(prescriptions.build(df), TABLES["prescriptions"])
    got = {(r.column_name, r.rule): r.violations for r in report.collect()}
    assert got[("atc_category", "declared_category")] == 1   # Q only; missing -> _none
    assert ("atc_id", "not_null") not in got                  # atc_id is nullable


def test_coverage_from_two_plan_points(spark):
    bounds = spark.createDataFrame([("1990",), ("1985",), (None,)], "y string")
    counts = spark.createDataFrame([(1,), (4,)], "n long")
    r = coverage_of_parts("t", bounds, "y", "y", counts, F.col("n") * 2).first()
    assert (r.table_name, r.first, r.last, r.rows) == ("t", "1985", "1990", 10)
    empty = spark.createDataFrame([], "y string, n long")
    for r in (coverage_row("e", empty, "y", "y").first(),
              coverage_of_parts("e", empty, "y", "y", empty, F.col("n")).first()):
        assert (r.first, r.last, r.rows) == (None, None, 0)


def test_group_count_inventory_and_reconciliation(spark):
    landed = spark.createDataFrame(
        [("a", "1"), ("a", "2"), ("b", "1"), (None, "1")], "source_file string, k string")
    assert rows(group_count(landed, "k")) == [("1", 3), ("2", 1)]
    want = [(None, 1, 1, 0), ("a", 2, 1, 1), ("b", 1, 1, 0)]
    cols = ("source_file", "landed_rows", "curated_rows", "dropped_rows")
    assert rows(rows_per_file(landed, F.col("k") == "1", "t"), *cols) == want
    curated = landed.where("k = '1'").groupBy("source_file").agg(
        F.count(F.lit(1)).alias("curated_rows"))
    assert rows(reconcile_counts(landed, curated, "t"), *cols) == want
    files = spark.createDataFrame([("x", "1990", "x1990.csv"), ("x", "1985", "x1985.csv"),
                                   ("x", "1986", "x1986.csv")],
                                  "dataset string, period string, file_name string")
    counted = spark.createDataFrame([("x1990.csv", 1), ("x1985.csv", 2)],
                                    "file_name string, rows long")
    inv = file_inventory(files, counted).first()
    assert (inv.n_files, inv.first_period, inv.last_period, inv.periods, inv.source_files,
            inv.rows) == (3, "1985", "1990", "1985,1986,1990", "x1985.csv,x1986.csv,x1990.csv", 3)


def test_joined_contract_report_equals_the_report_of_the_join(spark):
    from regcurate.plans import diagnoses
    spec = TABLES["diagnoses"]
    adm = spark.createDataFrame(
        [("1", "p", None, "1990-01-01", "x", "lpr_adm1990.sas7bdat"),
         ("1", "q", "0", "", None, "lpr_adm1990.sas7bdat"),
         ("2", "r", "0", "1990-01-01", None, "lpr_adm1990.sas7bdat")],
        "RECNUM string, PNR string, C_PATTYPE string, D_INDDTO string, D_UDDTO string, "
        "source_file string")
    dia = spark.createDataFrame(
        [("1", None, "A", "lpr_diag1990.sas7bdat"), ("1", "", None, "lpr_diag1990.sas7bdat"),
         ("3", None, "A", "lpr_diag1990.sas7bdat")],
        "RECNUM string, C_DIAG string, C_DIAGTYPE string, source_file string")
    inputs = {"lpr_adm": adm, "lpr_diag": dia}
    got = joined_contract_report(
        spec, diagnoses.record_columns(),
        lambda r, d: diagnoses.counts(inputs, record_sums=r, diagnosis_sums=d))
    assert rows(got) == rows(contract_report(diagnoses.build(inputs), spec))


def test_out_of_order_counts_within_and_across_files(spark, tmp_path):
    for name, values in (("a", ["1", "3", "2", None]), ("b", ["0", "5"]), ("c", ["6"])):
        spark.createDataFrame([(v,) for v in values], "k string").coalesce(1) \
            .write.parquet(str(tmp_path / "w" / name))
        part = next((tmp_path / "w" / name).glob("part-*"))
        (tmp_path / "t").mkdir(exist_ok=True)
        part.rename(tmp_path / "t" / f"{name}.parquet")
    r = out_of_order(spark.read.parquet(str(tmp_path / "t")), ["k"]).first()
    assert (r.rows, r.out_of_order) == (7, 2)       # 3 > 2 and 2 > NULL; NULL < 0, 5 < 6


def test_out_of_order_moves_no_rows(spark, tmp_path):
    """Several keys, NULLs, runs cut by batches and by splits of a file; the rows are
    compared below the first shuffle."""
    r, path = random.Random(3), str(tmp_path / "t")
    data = [(r.choice("abc") if k % 11 else None, str(r.randrange(9)) if k % 7 else None, k)
            for k in range(900)]
    spark.createDataFrame(data, "k string, m string, v int").repartition(3, "v") \
        .sortWithinPartitions(F.expr("v div 100"), "k").write.option("parquet.block.size", 1024) \
        .parquet(path)
    want, last = 0, None
    for file in sorted((tmp_path / "t").glob("part-*")):
        for row in pq.read_table(file).to_pylist():
            now = tuple((row[c] is not None, row[c] or "") for c in ("k", "m"))
            want, last = want + (last is not None and last > now), now
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    own.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    got = out_of_order(own.read.parquet(path), ["k", "m"])
    assert tuple(got.first()) == (900, want) and want > 100
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "Exchange" not in plan[plan.index("MapInArrow"):]
