import pytest

from helpers import rows
from regcurate.operators.dedup import (first_file_wins, first_file_wins_window,
                                       one_row_per_key, rows_in_first_file)
from regcurate.plans import diagnoses, population
from regcurate.specs.registers import REGISTERS

BEF = [*REGISTERS["bef"].columns, "source_file"]


def _bef(spark, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in BEF))


@pytest.mark.parametrize("build", [population.build, population.build_window])
def test_first_file_wins_keeps_all_rows_of_first_file(spark, build):
    data = [
        ("7", "1", "1970-01-01", "1", None, None, "f", "a", "b", "c", "bef198512.sas7bdat"),
        ("7", "2", "1970-01-02", "1", None, None, "f", "a", "b", "c", "bef198512.sas7bdat"),
        ("7", "1", "1970-01-03", "1", None, None, "f", "a", "b", "c", "bef198612.sas7bdat"),
        ("8", "1", "1980-01-01", "1", None, None, "g", "a", "b", "c", "bef198612.sas7bdat"),
    ]
    out = build(_bef(spark, data))
    assert rows(out, "person_id", "born_at", "source_file") == [
        ("7", "1970-01-01", "bef198512.sas7bdat"),
        ("7", "1970-01-02", "bef198512.sas7bdat"),
        ("8", "1980-01-01", "bef198612.sas7bdat"),
    ]
    assert out.columns == population.SPEC.names
    uniq = population.build_unique(_bef(spark, data))
    # ties broken on all columns in contract order: gender "f" < "m"
    assert rows(uniq, "person_id", "born_at") == [("7", "1970-01-02"), ("8", "1980-01-01")]


@pytest.mark.parametrize("form", [first_file_wins, first_file_wins_window])
def test_hot_key_is_exact(spark, form):
    # one key holds a third of the rows, spread over files: result stays whole
    data = [("hot", f"f{i % 3}", i) for i in range(3000)] + \
           [(f"k{i}", f"f{i % 2}", i) for i in range(6000)]
    df = spark.createDataFrame(data, "k string, source_file string, v int")
    got = form(df, "k")
    assert got.where("k = 'hot'").count() == 1000
    assert got.where("k <> 'hot'").count() == 6000
    assert one_row_per_key(df, "k").count() == 6001
    assert one_row_per_key(df, "k").where("k = 'hot'").first().v == 0


@pytest.mark.parametrize("form", [first_file_wins, first_file_wins_window])
def test_missing_file_name_or_key(spark, form):
    """A missing file name comes first; a missing key is a key of its own."""
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "f1", 2), ("b", "f1", 3), ("b", "f1", 4), ("b", "f0", 5),
         (None, "f1", 6), (None, "f2", 7)], "k string, source_file string, v int")
    assert sorted(r.v for r in form(df, "k").collect()) == [1, 5, 6]
    got = {(r.k, r._ordinal): r._rows for r in rows_in_first_file(df, "k").collect()}
    assert got == {("a", 1): 1, ("b", 2): 1, (None, 3): 1}


def _adm(spark, data):
    return spark.createDataFrame(data, "RECNUM string, PNR string, C_PATTYPE string, "
                                       "D_INDDTO string, D_UDDTO string, source_file string")


def _diag(spark, data):
    return spark.createDataFrame(data, "RECNUM string, C_DIAG string, C_DIAGTYPE string, "
                                       "source_file string")


def test_record_and_diagnosis_must_share_period_and_register(spark):
    inputs = {
        "lpr_adm": _adm(spark, [("10", "p1", "0", "1985-01-01", None, "lpr_adm1985.sas7bdat"),
                                ("20", "p2", "0", "1986-01-01", "1986-02-01",
                                 "lpr_adm1986.sas7bdat")]),
        "lpr_diag": _diag(spark, [("10", "DF1", "A", "lpr_diag1986.sas7bdat"),
                                  ("20", "DF2", "A", "lpr_diag1986.sas7bdat"),
                                  ("20", "DF3", "B", "lpr_diag1986.sas7bdat")]),
        "psyk_adm": _adm(spark, [("20", "p9", "1", "1986-01-01", None,
                                  "psyk_adm1986.sas7bdat")]),
        "psyk_diag": _diag(spark, [("10", "DF9", "A", "psyk_diag1986.sas7bdat")]),
    }
    out = diagnoses.build(inputs)
    assert out.columns == diagnoses.SPEC.names
    assert rows(out, "person_id", "record_id", "diagnosis_id") == [
        ("p2", "20", "DF2"), ("p2", "20", "DF3")]
    assert set(diagnoses.missing_pairs(inputs)) == {"pcrr1", "pcrr2", "lpr3"}


def test_self_paired_register_multiplies_repeated_ids(spark):
    icd8 = spark.createDataFrame(
        [("5", "p", "1", "1980-01-01", None, "a", "x", "patient_icd8.sas7bdat"),
         ("5", "p", "1", "1980-01-01", None, "b", "y", "patient_icd8.sas7bdat")],
        "PAT_SEQ string, CPRNR string, PTTYPE string, INDLDATO string, UDSKDATO string, "
        "HOVEDDIAG string, MODIFHD string, source_file string")
    out = diagnoses.build({"patient_icd8": icd8})
    assert out.count() == 4
