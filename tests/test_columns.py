from helpers import rows
from regcurate.functions.columns import (atc_category, period_from_file_name, recode_gender,
                                         year_from_file_name)
from regcurate.plans import employment
from regcurate.specs.registers import REGISTERS


def _ras(spark, files):
    cols = [*REGISTERS["ras"].columns, "source_file"]
    data = [(str(i + 1), "a", "n", "s", "ss", "077", "bk", "db07", f) for i, f in enumerate(files)]
    return spark.createDataFrame(data, cols)


def test_every_era_boundary(spark):
    files = [f"ras{y}.sas7bdat" for y in (1991, 1992, 1993, 1994, 1995, 1996, 2007, 2008)]
    files.append("ras.sas7bdat")
    out = employment.build(_ras(spark, files)).collect()
    by_file = {r.source_file: r for r in out}
    status = [by_file[f].status_source for f in files]
    industry = [by_file[f].industry_source for f in files]
    assert status == ["ARBSTIL"] * 3 + ["NYARB"] * 2 + ["SOCSTIL_KODE"] * 2 + \
        ["SOC_STATUS_KODE"] * 2
    assert industry == ["BRANCHE_77"] + ["BRANCHE_KODE"] * 6 + ["ARB_HOVED_BRA_DB07"] * 2
    # the value comes from the named column
    assert by_file["ras1991.sas7bdat"].status == "a"
    assert by_file["ras1994.sas7bdat"].status == "n"
    assert by_file["ras1996.sas7bdat"].status == "s"
    assert by_file["ras.sas7bdat"].status == "ss"
    assert by_file["ras1991.sas7bdat"].industry == "077"
    assert by_file["ras2008.sas7bdat"].industry == "db07"
    assert by_file["ras.sas7bdat"].year is None


def test_month_in_file_name_compares_as_string(spark):
    out = {r.year: r for r in employment.build(_ras(
        spark, ["ras199312.sas7bdat", "ras199112.sas7bdat"])).collect()}
    assert out["199312"].status_source == "SOC_STATUS_KODE"
    assert out["199312"].industry_source == "BRANCHE_KODE"
    assert out["199112"].industry_source == "BRANCHE_77"      # strictly below "1992"


def test_year_from_file_name_is_anchored(spark):
    df = spark.createDataFrame([("ind2001.sas7bdat",), ("ind.sas7bdat",), ("xind2001.sas7bdat",),
                                ("ind2001.csv",), ("ind2001xsas7bdat",)], ["f"])
    got = [r[0] for r in df.select(year_from_file_name("f", "ind")).collect()]
    assert got == ["2001", None, None, "2001", None]


def test_period_of_undated_register_is_zero(spark):
    df = spark.createDataFrame([("patient_icd8.sas7bdat",), ("bef198512.sas7bdat",),
                                ("bef.sas7bdat",)], ["f"])
    got = df.select(period_from_file_name("f", "patient_icd8", False).alias("u"),
                    period_from_file_name("f", "bef", True).alias("d")).collect()
    assert [r.u for r in got] == ["0", "0", "0"]
    assert [r.d for r in got] == ["0", "198512", "0"]


def test_gender_recode(spark):
    df = spark.createDataFrame([("1",), ("2",), ("9",), (None,)], "k string")
    assert [r[0] for r in df.select(recode_gender("k")).collect()] == ["m", "f", "f", None]


def test_atc_category(spark):
    df = spark.createDataFrame([("N02BE01",), ("Q1",), ("",), (None,)], "a string")
    assert [r[0] for r in df.select(atc_category("a")).collect()] == ["N", "Q", "_none", "_none"]


def test_null_and_empty_keys_dropped(spark):
    from regcurate.plans import income
    cols = [*REGISTERS["ind"].columns, "source_file"]
    data = [(k, "1", "08", "1", "10", "4", "5", "2", "0", "1", "3.8", "ind2001.sas7bdat")
            for k in ("", None, "0001")]
    out = income.build(spark.createDataFrame(data, "{}".format(
        ", ".join(f"{c} string" for c in cols))))
    assert rows(out, "person_id") == [("0001",)]
    r = out.first()
    assert r.tax_sum == "3.8" and r.income_employment == "4" and r.income_social_contrib == "5"
    assert out.columns[5] == "income_social_contrib"
