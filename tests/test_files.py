"""File sources and sinks on small literal files."""

import json
import os
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from regcurate import catalog_updates
from regcurate.operators.landing import land_register
from regcurate.operators.profile import file_inventory
from regcurate.session import fine_scans
from regcurate.sources.files import land_folder, read_register, register_files, rows_by_file
from regcurate.sources.fixtures import stage_all, stage_extracts
from regcurate.specs.registers import REGISTERS, RegisterSpec


def _write_csv(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_layouts_read_by_header(spark, tmp_path):
    spec = RegisterSpec("zz", ("A", "B"))
    _write_csv(tmp_path / "zz2001.csv", "A,B\na1,b1\n")
    _write_csv(tmp_path / "zz2002.csv", "B,A\nb2,a2\n")
    out = read_register(spark, str(tmp_path), spec, "csv")
    assert rows(out) == [("a1", "b1", "zz2001.csv"), ("a2", "b2", "zz2002.csv")]


def test_csv_missing_and_extra_columns_are_tolerated(spark, tmp_path):
    spec = RegisterSpec("zz", ("A", "B", "C"))
    _write_csv(tmp_path / "zz2001.csv", "B,X,A\nb1,x,a1\n")
    out = land_folder(spark, str(tmp_path), spec, fmt="csv")
    assert out.columns == ["A", "B", "C", "source_file", "period"]
    assert rows(out) == [("a1", "b1", None, "zz2001.csv", "2001")]


def test_key_tokens_na_empty_quoted_empty_are_dropped(spark, tmp_path):
    from regcurate.plans import education
    spec = REGISTERS["udda"]
    _write_csv(tmp_path / "udda2001.csv",
               "PNR,HFAUDD,HFINSTNR,HF_KILDE,HF_VFRA,UDD\n"
               "NA,1,2,3,2001-01-01,9\n"
               ",1,2,3,2001-01-01,9\n"
               '"",1,2,3,2001-01-01,9\n'
               "0042,1,2,3,2001-01-01,9\n")
    landed = land_folder(spark, str(tmp_path), spec, fmt="csv")
    assert landed.count() == 4
    assert rows(education.build(landed), "person_id") == [("0042",)]


def test_header_only_input_gives_empty_table_with_schema(spark, tmp_path):
    from regcurate.plans import income
    spec = REGISTERS["ind"]
    _write_csv(tmp_path / "ind2001.csv", ",".join(spec.columns) + "\n")
    out = income.build(land_folder(spark, str(tmp_path), spec, fmt="csv"))
    assert out.count() == 0
    assert out.columns == income.SPEC.names


def test_parquet_register_whitelist_and_periods(spark, tmp_path):
    spec = REGISTERS["faik"]
    for name in ("faik2001.parquet", "faik2002.parquet", "faikx2001.parquet", "other2001.parquet"):
        pdf = pd.DataFrame({c: [f"{name}:{c}"] for c in spec.columns[:-1]})  # one column absent
        pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), tmp_path / name)
    files = register_files(spark, str(tmp_path), True, {"faik": spec})
    assert rows(files, "file_name", "period") == [("faik2001.parquet", "2001"),
                                                  ("faik2002.parquet", "2002")]
    out = land_folder(spark, str(tmp_path), spec)
    assert rows(out, "source_file", "period") == [("faik2001.parquet", "2001"),
                                                  ("faik2002.parquet", "2002")]
    assert out.where(out[spec.columns[-1]].isNotNull()).count() == 0


def test_undated_folder_period_zero(spark, tmp_path):
    spec = REGISTERS["patient_icd8"]
    pdf = pd.DataFrame({c: ["1"] for c in spec.columns})
    pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), tmp_path / "patient_icd8.parquet")
    out = land_folder(spark, str(tmp_path), spec)
    assert rows(out, "source_file", "period") == [("patient_icd8.parquet", "0")]


def test_pipeline_end_to_end_with_sidecars(spark, tmp_path):
    """Write fixture registers as yearly files, land them, curate them."""
    from helpers import SF_SMALL
    from regcurate.plans.pipeline import run
    from regcurate.sources.fixtures import register_view

    dated, undated, out = tmp_path / "grund", tmp_path / "external", tmp_path / "out"
    dated.mkdir()
    undated.mkdir()
    for name in ("bef", "ind", "lpr_adm", "lpr_diag", "patient_icd8", "lmdb"):
        pdf = register_view(spark, SF_SMALL, name).toPandas()
        for src, part in pdf.groupby("source_file"):
            stem = src.rsplit(".", 1)[0]
            folder = undated if not REGISTERS[name].dated or not stem[-1].isdigit() else dated
            pq.write_table(pa.Table.from_pandas(part.drop(columns="source_file"),
                                                preserve_index=False),
                           folder / f"{stem}.parquet")
    result = run(spark, str(dated), str(undated), str(out))
    assert set(result["stage1"]) == {"bef", "ind", "lpr_adm", "lpr_diag", "patient_icd8", "lmdb"}
    assert {"income", "population", "prescriptions", "diagnoses"} <= set(result["stage2"])
    inc = spark.read.parquet(str(out / "stage2" / "income"))
    side = json.load(open(str(out / "stage2" / "income_metadata.json")))
    assert side["size"] == inc.count() > 0
    assert side["period"]["first"] <= side["period"]["last"]
    assert list(side["columns"]) == inc.columns
    pid = side["columns"]["person_id"]
    assert pid["index"] == 0 and pid["nullable"] is False
    assert pid["relations"] == [{"kind": "originates_from", "target": "urn:column:dst:IND:PNR"}]
    assert side["columns"]["income_social_contrib"]["index"] == 5
    # undated ind copy lands with period 0 and gives a null tax year
    assert inc.where("tax_year IS NULL").count() == \
        inc.where("source_file = 'ind.parquet'").count()
    presc = spark.read.parquet(str(out / "stage2" / "prescriptions"))
    assert "atc_category" in presc.columns
    assert os.path.isdir(out / "stage2" / "prescriptions" / "atc_category=_none")
    diag_side = json.load(open(str(out / "stage2" / "diagnoses_metadata.json")))
    assert diag_side["size"] == spark.read.parquet(str(out / "stage2" / "diagnoses")).count()
    # bounds observed in the write equal a separate aggregate at the same plan point
    from pyspark.sql import functions as F
    from regcurate.plans import diagnoses, population
    from regcurate.plans.pipeline import landed_inputs
    inputs = landed_inputs(spark, str(out), result["stage1"])
    b = diagnoses.records(inputs).agg(F.min("starts_at"), F.max("ends_at")).first()
    assert (diag_side["period"]["first"], diag_side["period"]["last"]) == (b[0], b[1])
    pop_side = json.load(open(str(out / "stage2" / "population_metadata.json")))
    assert pop_side["columns"]["gender"]["enum"] == [{"value": "m"}, {"value": "f"}]
    assert pop_side["columns"]["born_at"]["format"] == "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    assert diag_side["sorted_by"] == ["person_id", "record_id"]
    assert diag_side["columns"]["ends_at"]["nullable"] is True
    b = population.candidates(inputs["bef"]).agg(F.min("born_at"), F.max("born_at")).first()
    assert (pop_side["period"]["first"], pop_side["period"]["last"]) == (b[0], b[1])
    assert pop_side["size"] == spark.read.parquet(str(out / "stage2" / "population")).count()


def test_partition_folder_layout(spark, tmp_path):
    from helpers import SF_SMALL
    from regcurate.sources.fixtures import register_view
    src = str(tmp_path / "src")
    ras = register_view(spark, SF_SMALL, "ras")
    ras.write.partitionBy("source_file").parquet(src)
    out = land_folder(spark, src, REGISTERS["ras"], layout="partitioned")
    dated = ras.where("source_file <> 'ras.sas7bdat'")
    assert out.count() == dated.count()          # the undated copy is not a dated extract
    assert rows(out.groupBy("period").count()) == rows(
        land_register(dated, REGISTERS["ras"]).groupBy("period").count())
    undated = land_folder(spark, src, REGISTERS["ras"], dated=False, layout="partitioned")
    assert rows(undated.groupBy("period").count()) == [("0", ras.count() - dated.count())]
    akm = land_folder(spark, src, REGISTERS["akm"], layout="partitioned")
    assert akm.count() == 0


def test_carried_source_file_is_kept(spark, tmp_path):
    """A landed CSV copy that carries ``source_file`` keeps the original name."""
    spec = REGISTERS["faik"]
    cols = list(spec.columns)
    _write_csv(tmp_path / "faik2001.csv", ",".join(cols + ["source_file"]) + "\n"
               + ",".join(["1"] * len(cols) + ["faik2001.sas7bdat"]) + "\n")
    out = land_folder(spark, str(tmp_path), spec, fmt="csv")
    assert rows(out, "source_file", "period") == [("faik2001.sas7bdat", "2001")]
    pdf = pd.DataFrame({c: ["1"] for c in cols})
    pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), tmp_path / "faik2002.parquet")
    got = land_folder(spark, str(tmp_path), spec)
    assert rows(got, "source_file") == [("faik2002.parquet",)]


def test_csv_header_longer_than_a_read_with_bom_and_quotes(spark, tmp_path):
    spec = RegisterSpec("zz", ("A", "B", "C,D"))
    filler = ",".join(f"column_{i:05d}" for i in range(6000))
    head = f'A,{filler},B,"C,D"'
    assert len(head) > 1 << 16
    body = "a1," + ",".join("x" * 6000) + ",b1,cd1"
    (tmp_path / "zz2001.csv").write_bytes(b"\xef\xbb\xbf" + f"{head}\r\n{body}\r\n".encode())
    (tmp_path / "zz2002.csv").write_text('"C,D",A,B\ncd2,a2,b2\n')
    out = read_register(spark, str(tmp_path), spec, "csv")
    assert rows(out) == [("a1", "b1", "cd1", "zz2001.csv"), ("a2", "b2", "cd2", "zz2002.csv")]


def test_typed_parquet_reads_as_text(spark, tmp_path):
    from datetime import date, datetime
    from decimal import Decimal
    spec = RegisterSpec("zz", ("I", "D", "T", "F", "M", "S"))
    pq.write_table(pa.table({
        "I": pa.array([1, None], pa.int64()), "D": pa.array([date(2001, 2, 3), None]),
        "T": pa.array([datetime(2001, 2, 3), datetime(2001, 2, 3, 4, 5, 6)], pa.timestamp("us")),
        "F": pa.array([2001.0, 0.25]), "M": pa.array([Decimal("12.50"), Decimal("3.00")]),
        "S": ["007", ""]}), tmp_path / "zz2001.parquet")
    pq.write_table(pa.table({"S": ["x"], "I": ["0042"]}), tmp_path / "zz2002.parquet")
    out = read_register(spark, str(tmp_path), spec)
    assert rows(out) == [
        (None, None, "2001-02-03 04:05:06", "0.25", "3", "", "zz2001.parquet"),
        ("0042", None, None, None, None, "x", "zz2002.parquet"),
        ("1", "2001-02-03", "2001-02-03", "2001", "12.50", "007", "zz2001.parquet")]


def test_missing_key_column_is_an_error(spark, tmp_path):
    import pytest
    from regcurate.plans.pipeline import MissingKeyColumn, curate, land
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    _write_csv(src / "udda2001.csv", "PNR,HFAUDD\n1,2\n")
    _write_csv(src / "udda2002.csv", "pnr,HFAUDD\n1,2\n")
    regs = {"udda": REGISTERS["udda"]}
    landed = land(spark, str(src), None, out, "csv", regs)
    with pytest.raises(MissingKeyColumn, match="udda2002.csv has no PNR"):
        curate(spark, out, landed, registers=regs)
    with pytest.warns(UserWarning, match="population: no landed files of bef"):
        side = curate(spark, out, landed, registers=regs, strict_keys=False)
    assert side["education"]["size"] == 1


def test_failing_listing_raises_and_absent_folder_does_not(spark, tmp_path):
    import pytest
    from regcurate.plans.pipeline import land
    assert land(spark, str(tmp_path / "absent"), None, str(tmp_path / "out")) == {}
    with pytest.raises(Exception):
        land(spark, "nosuchscheme://bucket/dir", None, str(tmp_path / "out"))


def test_every_dodsaa_register_goes_into_deaths(spark, tmp_path):
    from regcurate.plans.pipeline import curate, land
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    cols = REGISTERS["dodsaasg"].columns
    regs = {n: RegisterSpec(n, cols) for n in ("dodsaasg", "dodsaax")}
    for n in regs:
        _write_csv(src / f"{n}2001.csv", ",".join(cols) + "\n" + ",".join(f"{n}{c}" for c in cols)
                   + "\n")
    side = curate(spark, out, land(spark, str(src), None, out, "csv", regs), registers=regs)
    assert side["deaths"]["size"] == 2
    got = spark.read.parquet(out + "/stage2/deaths")
    assert rows(got, "person_id", "cause_4_icd_id") == [
        ("dodsaasgPNR", "dodsaasgC_DOD_1D"), ("dodsaaxPNR", "dodsaaxC_DOD_1D")]


def test_sidecar_tells_columns_and_text_format(spark, tmp_path):
    from regcurate.sinks.writers import read_json, write_curated
    from regcurate.sources.fixtures import register_view
    from helpers import SF_SMALL
    path = str(tmp_path / "faik")
    write_curated("family_income", {"faik": register_view(spark, SF_SMALL, "faik")}, path, "csv")
    doc = read_json(spark, path + "_metadata.json")
    assert doc["file_format"] == {"extension": "csv", "type": "text", "delimiter": ",",
                                  "quote": '"', "linebreaks": "\n"}
    assert all(c["description"] and c["examples"] for c in doc["columns"].values())


def test_curate_leaves_session_settings(spark, tmp_path):
    from regcurate.session import sized_shuffles
    from regcurate.sources.fixtures import register_view
    from helpers import SF_SMALL
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    df = register_view(spark, SF_SMALL, "faik")
    with sized_shuffles(spark, [df], target_bytes=1):
        assert spark.conf.get(key) == old             # set at launch: left alone
    assert spark.conf.get(key) == old


def test_cluster_session_must_name_a_shared_folder(monkeypatch):
    import pytest
    from types import SimpleNamespace
    from regcurate import session
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                         getConf=lambda: {})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_an_extract_of_several_writers_is_a_folder(spark, tmp_path):
    """With ``parts`` no task gathers a whole extract; the folder is listed, counted
    and landed under the extract's name."""
    spec = REGISTERS["faik"]
    rows = spark.range(400).select(
        *[F.col("id").cast("string").alias(c) for c in spec.columns],
        F.when(F.col("id") < 390, "faik2001.sas7bdat").otherwise("faik2002.sas7bdat")
        .alias("source_file")).repartition(4)
    base = str(tmp_path)
    paths = stage_extracts(rows, spec, base, parts=True)
    stage_extracts(rows.coalesce(1), RegisterSpec("zzz", spec.columns), base + "/one", parts=True)
    assert [p.rsplit("/", 1)[1] for p in paths] == ["faik2001.parquet", "faik2002.parquet"]
    parts = [pq.read_metadata(p).num_rows for p in (tmp_path / "dated/faik2001.parquet").glob("part-*")]
    assert len(parts) == 4 and sum(parts) == 390
    assert (tmp_path / "one/dated/faik2001.parquet").is_file()
    listed = register_files(spark, base + "/dated", True, {"faik": spec}, "faik*.parquet")
    assert {r["file_name"] for r in listed.collect()} == {"faik2001.parquet", "faik2002.parquet"}
    assert {(r["file_name"], r["rows"]) for r in rows_by_file(spark, base + "/dated").collect()} \
        == {("faik2001.parquet", 390), ("faik2002.parquet", 10)}
    landed = land_folder(spark, base + "/dated", spec)
    assert {(r[0], r[1], r[2]) for r in landed.groupBy("period", "source_file").count().collect()} \
        == {("2001", "faik2001.parquet", 390), ("2002", "faik2002.parquet", 10)}


def test_registers_are_written_in_their_own_columns(spark, tmp_path, monkeypatch):
    """No row carries the columns of other registers to disk, with or without folders
    per register."""
    stage_all(spark, SF_SMALL, str(tmp_path))
    assert pq.read_schema(tmp_path / "undated/diag_icd10.parquet").names == \
        list(REGISTERS["diag_icd10"].columns)
    seen = []
    monkeypatch.setattr(catalog_updates, "counts_by_partition",
                        lambda spark, path, schema, keys: seen.append(path))
    catalog_updates.q_landed_counts(spark, SF_SMALL)
    one = next(Path(seen[0].removeprefix("file:")).glob("register=faik/*/*/part-*"))
    assert pq.read_schema(one).names == list(REGISTERS["faik"].columns)


def test_fine_scans_leave_the_callers_session_alone(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before, own = spark.conf.get(key), fine_scans(spark, 1 << 20)
    assert own.conf.get(key) == str(1 << 20) and spark.conf.get(key) == before
    own.conf.set(key, "16m")
    assert fine_scans(own).conf.get(key) == "16m"
    assert own.conf.get("spark.sql.shuffle.partitions") == \
        spark.conf.get("spark.sql.shuffle.partitions")


def test_categories_are_written_where_their_rows_stand(spark, tmp_path, monkeypatch):
    from regcurate.sinks import writers

    lmdb = spark.range(3000).select(*[F.col("id").cast("string").alias(c)
                                      for c in REGISTERS["lmdb"].columns if c != "ATC"],
                                    F.expr("CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 > 0 THEN 'N02' "
                                           "ELSE concat(substr('ABC', 1 + int(id % 7 % 3), 1), '1') END")
                                    .alias("ATC"), F.lit("lmdb200112.sas7bdat").alias("source_file"))
    written, writer = [], writers._writer
    monkeypatch.setattr(writers, "_writer", lambda df, *a: written.append(df) or writer(df, *a))
    side = writers.write_curated("prescriptions", {"lmdb": lmdb.repartition(4)}, str(tmp_path / "p"))
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" not in plan
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "p"))
           .groupBy("atc_category").count().collect()}
    first = F.coalesce(F.nullif(F.substring("ATC", 1, 1), F.lit("")), F.lit("_none"))
    want = {r[0]: r[1] for r in lmdb.groupBy(first).count().collect()}
    assert got == want and len(got) == 5 and side["size"] == sum(got.values()) == 3000


def test_inventory_parses_names_once_a_file(spark, tmp_path):
    """No name is parsed or tested below the count of a file's rows."""
    for name, n in (("bef198512.parquet/part-0", 3), ("bef198512.parquet/part-1", 2),
                    ("zzz2001.parquet/part-0", 4)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / "w" / name))
        part = next((tmp_path / "w" / name).glob("part-*.parquet"))
        to = tmp_path / "dated" / f"{name}.parquet"
        to.parent.mkdir(parents=True, exist_ok=True)
        part.rename(to)
    root = str(tmp_path / "dated")
    files = register_files(spark, root).select("dataset", "period", "file_name").distinct()
    inventory = file_inventory(files, rows_by_file(spark, root))
    assert [(r.dataset, r.n_files, r.source_files, r.rows) for r in inventory.collect()] == [
        ("bef", 1, "bef198512.parquet", 5)]
    plan = inventory._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in plan if "Filter" in x and "file_path" in x]
    counts = [x for x in plan if "Aggregate" in x and "count(1)" in x]
    assert counts and not any("RLIKE" in x.split("], [")[0] for x in counts)
