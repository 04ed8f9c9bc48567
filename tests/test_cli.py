import json
import shutil

import pyarrow as pa
import pyarrow.parquet as pq

from helpers import SF_SMALL
from regcurate.cli import main
from regcurate.sources.fixtures import register_view
from regcurate.specs.registers import REGISTERS


def test_cli_run_and_summarise(spark, tmp_path, capsys):
    dated, undated, out = tmp_path / "grund", tmp_path / "external", tmp_path / "out"
    dated.mkdir()
    undated.mkdir()
    spec = {"stage1": {n: {"columns": list(REGISTERS[n].columns)} for n in ("ras", "faik")}}
    spec_path = tmp_path / "metadata.json"
    spec_path.write_text(json.dumps(spec))
    for name in ("ras", "faik", "udda"):          # udda is not in the spec: skipped
        pdf = register_view(spark, SF_SMALL, name).toPandas()
        for src, part in pdf.groupby("source_file"):
            stem = src.rsplit(".", 1)[0]
            folder = dated if stem[-1].isdigit() else undated
            pq.write_table(pa.Table.from_pandas(part.drop(columns="source_file"),
                                                preserve_index=False), folder / f"{stem}.parquet")
    assert main(["run", str(spec_path), str(dated), str(undated), str(out),
                 "--output-format", "csv", "--sorted"]) == 0
    result = json.loads(capsys.readouterr().out)
    assert set(result["stage1"]) == {"ras", "faik"}
    assert set(result["stage2"]) == {"employment", "family_income"}
    emp = spark.read.option("header", "true").csv(str(out / "stage2" / "employment"))
    assert emp.count() == result["stage2"]["employment"]
    # --sorted: part files in name order hold person ids in ascending order
    import glob as _glob
    ids = []
    for f in sorted(_glob.glob(str(out / "stage2" / "employment" / "part-*.csv"))):
        ids += [r.person_id for r in spark.read.option("header", "true").csv(f).collect()]
    assert ids == sorted(ids) and len(ids) == emp.count()
    assert main(["summarise", "status_source", str(out / "stage2" / "employment"),
                 str(tmp_path / "summary"), "--format", "csv"]) == 0
    capsys.readouterr()
    summary = spark.read.option("header", "true").csv(str(tmp_path / "summary"))
    assert sum(int(r.n) for r in summary.collect()) == emp.count()


def test_run_on_existing_stage1_csv_folder(spark, tmp_path, capsys):
    """Stage-1 CSV outputs in one folder (dated and undated side by side,
    each carrying source_file with the original extract name, NA for
    missing values) can be curated directly."""
    stage1, out = tmp_path / "stage1", tmp_path / "out"
    stage1.mkdir()
    for name in ("bef", "ind", "patient_icd8"):
        pdf = register_view(spark, SF_SMALL, name).toPandas()
        for src, part in pdf.groupby("source_file"):
            part.to_csv(stage1 / (src.rsplit(".", 1)[0] + ".csv"), index=False, na_rep="NA")
    spec = {"stage1": {n: {"columns": list(REGISTERS[n].columns)}
                       for n in ("bef", "ind", "patient_icd8")}}
    spec_path = tmp_path / "spec.json"
    spec_path.write_text(json.dumps(spec))
    assert main(["run", str(spec_path), str(stage1), str(stage1), str(out),
                 "--format", "csv"]) == 0
    result = json.loads(capsys.readouterr().out)
    assert set(result["stage2"]) >= {"income", "population", "diagnoses"}
    inc = spark.read.parquet(str(out / "stage2" / "income"))
    names = {r.source_file for r in inc.select("source_file").distinct().collect()}
    assert names and all(n.endswith(".sas7bdat") for n in names)
    assert "ind.sas7bdat" in names                      # the undated copy, tax_year null
    assert inc.where("source_file = 'ind.sas7bdat' AND tax_year IS NOT NULL").count() == 0
    expected = register_view(spark, SF_SMALL, "ind").where("PNR <> ''").count()
    assert result["stage2"]["income"] == expected


def test_cli_incremental_land_then_curate(spark, tmp_path, capsys):
    dated, undated, out = tmp_path / "grund", tmp_path / "external", tmp_path / "out"
    dated.mkdir()
    undated.mkdir()
    spec = {"stage1": {"faik": {"columns": list(REGISTERS["faik"].columns)}}}
    spec_path = tmp_path / "spec.json"
    spec_path.write_text(json.dumps(spec))
    pdf = register_view(spark, SF_SMALL, "faik").toPandas()
    groups = sorted(pdf.groupby("source_file"), key=lambda g: g[0])
    half = len(groups) // 2

    def write(parts):
        for src, part in parts:
            pq.write_table(pa.Table.from_pandas(part.drop(columns="source_file"),
                                                preserve_index=False),
                           dated / (src.rsplit(".", 1)[0] + ".parquet"))

    args = ["land", str(spec_path), str(dated), str(undated), str(out), "--incremental"]
    write(groups[:half])
    assert main(args) == 0
    capsys.readouterr()
    write(groups[half:])
    assert main(args) == 0                     # lands only the new files
    assert main(args) == 0                     # nothing new: no rows added
    capsys.readouterr()
    assert main(["curate", str(out)]) == 0
    result = json.loads(capsys.readouterr().out)
    expected = register_view(spark, SF_SMALL, "faik").where("FAMILIE_ID <> ''").count()
    assert result["stage2"] == {"family_income": expected}
    assert result["missing"]["population"] == ["bef"]


def test_cli_incremental_csv_with_header_drift(spark, tmp_path, capsys):
    dated, undated, out = tmp_path / "grund", tmp_path / "external", tmp_path / "out"
    dated.mkdir()
    undated.mkdir()
    spec = {"stage1": {"faik": {"columns": list(REGISTERS["faik"].columns)}}}
    spec_path = tmp_path / "spec.json"
    spec_path.write_text(json.dumps(spec))
    pdf = register_view(spark, SF_SMALL, "faik").toPandas()
    for i, (src, part) in enumerate(sorted(pdf.groupby("source_file"), key=lambda g: g[0])):
        part = part.drop(columns="source_file")
        if i % 2:                                  # every other year: columns reversed
            part = part[part.columns[::-1]]
        part.to_csv(dated / (src.rsplit(".", 1)[0] + ".csv"), index=False, na_rep="NA")
    args = ["land", str(spec_path), str(dated), str(undated), str(out), "--incremental",
            "--format", "csv"]
    assert main(args) == 0
    assert main(args) == 0                         # rerun: nothing new
    capsys.readouterr()
    assert main(["curate", str(out)]) == 0
    result = json.loads(capsys.readouterr().out)
    expected = register_view(spark, SF_SMALL, "faik").where("FAMILIE_ID <> ''")
    assert result["stage2"] == {"family_income": expected.count()}
    got = spark.read.parquet(str(out / "stage2" / "family_income"))
    # values sit under the right names whatever the file's column order
    want = {(r.FAMILIE_ID, r.FAMTYPE, r.FAMSKATTOT_13) for r in expected.collect()}
    assert {(r.family_id, r.family_kind, r.tax_sum) for r in got.collect()} == want


def test_cli_refresh(spark, tmp_path, capsys):
    """Two refreshes of a folder: the second lands what was added and withdrawn."""
    spec = REGISTERS["udda"]
    dated, out = tmp_path / "dated", str(tmp_path / "out")
    for name, persons in (("udda2000", ["a", "b"]), ("udda2001", ["c"])):
        rows = [tuple({"PNR": p}.get(c, "1") for c in spec.columns) for p in persons]
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in spec.columns))
        df.coalesce(1).write.parquet(str(tmp_path / name))
    dated.mkdir()

    def put(name):
        part = next((tmp_path / name).glob("part-*.parquet"))
        shutil.copy(part, dated / f"{name}.parquet")

    def refresh():
        args = ["refresh", _spec_file(tmp_path), str(dated), str(tmp_path / "none"), out]
        assert main(args) == 0
        return json.loads(capsys.readouterr().out)

    put("udda2000")
    assert refresh()["stage2"] == {"education": {"version": 1, "rows": 2}}
    put("udda2001")
    (dated / "udda2000.parquet").unlink()
    second = refresh()
    assert second["stage1"]["udda"]["added"] == ["udda2001.parquet"]
    assert second["stage1"]["udda"]["withdrawn"] == ["udda2000.parquet"]
    assert second["stage2"] == {"education": {"version": 2, "rows": 1}}


def _spec_file(tmp_path):
    path = tmp_path / "spec.json"
    path.write_text(json.dumps({"stage1": {"udda": {"columns": list(REGISTERS["udda"].columns)}}}))
    return str(path)
