import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

from regcurate.sources.files import read_landed
from regcurate.specs.registers import REGISTERS
from regcurate.streaming.landing import land_available_now


def _file(folder, name, n):
    spec = REGISTERS["ras"]
    pdf = pd.DataFrame({c: [f"{c}{i}" for i in range(n)] for c in spec.columns})
    pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), folder / name)


def test_available_now_lands_each_file_once(spark, tmp_path):
    src, out, ckpt = tmp_path / "src", tmp_path / "out", tmp_path / "ckpt"
    src.mkdir()
    _file(src, "ras2001.parquet", 3)
    _file(src, "ras2002.parquet", 2)
    _file(src, "akm2002.parquet", 9)       # another register: not landed here
    spec = REGISTERS["ras"]
    assert land_available_now(spark, str(src), None, spec, str(out), str(ckpt)) == 5
    assert land_available_now(spark, str(src), None, spec, str(out), str(ckpt)) == 0
    _file(src, "ras2003.parquet", 4)
    assert land_available_now(spark, str(src), None, spec, str(out), str(ckpt)) == 4
    landed = read_landed(spark, str(out), spec)
    assert landed.count() == 9
    got = {r.period: r.n for r in landed.groupBy("period").count().withColumnRenamed(
        "count", "n").collect()}
    assert got == {"2001": 3, "2002": 2, "2003": 4}


def test_incremental_pipeline_lands_new_files_only(spark, tmp_path):
    from regcurate.plans.pipeline import curate, land
    dated, undated, out = tmp_path / "grund", tmp_path / "external", tmp_path / "out"
    dated.mkdir()
    undated.mkdir()
    _file(dated, "ras2001.parquet", 3)
    _file(undated, "ras.parquet", 2)                  # undated copy: period 0
    regs = {"ras": REGISTERS["ras"]}
    landed = land(spark, str(dated), str(undated), str(out), registers=regs, incremental=True)
    table = read_landed(spark, landed["ras"], REGISTERS["ras"])
    assert table.count() == 5
    land(spark, str(dated), str(undated), str(out), registers=regs, incremental=True)
    assert read_landed(spark, landed["ras"], REGISTERS["ras"]).count() == 5
    _file(dated, "ras2002.parquet", 4)
    land(spark, str(dated), str(undated), str(out), registers=regs, incremental=True)
    table = read_landed(spark, landed["ras"], REGISTERS["ras"])
    assert {r.period: r["count"] for r in table.groupBy("period").count().collect()} == \
        {"0": 2, "2001": 3, "2002": 4}
    side = curate(spark, str(out), landed, registers=regs)["employment"]
    assert side["size"] == 9 and side["period"]["first"] == "2001"


def test_incremental_csv_landing_survives_header_drift(spark, tmp_path):
    src, out, ckpt = tmp_path / "src", tmp_path / "out", tmp_path / "ckpt"
    src.mkdir()
    spec = REGISTERS["faik"]
    cols = list(spec.columns)
    (src / "faik2001.csv").write_text(",".join(cols) + "\n" + ",".join(f"a{c}" for c in cols)
                                      + "\n")
    rev = cols[::-1]
    (src / "faik2002.csv").write_text(",".join(rev) + "\n" + ",".join(f"b{c}" for c in rev)
                                      + "\n")
    assert land_available_now(spark, str(src), None, spec, str(out), str(ckpt), "csv") == 2
    assert land_available_now(spark, str(src), None, spec, str(out), str(ckpt), "csv") == 0
    (src / "faik2003.csv").write_text(",".join(cols) + "\n" + ",".join(f"c{c}" for c in cols)
                                      + "\n")
    assert land_available_now(spark, str(src), None, spec, str(out), str(ckpt), "csv") == 1
    table = read_landed(spark, str(out), spec)
    got = {r.period: (r.FAMILIE_ID, r.FAMTYPE, r.source_file) for r in table.collect()}
    assert got == {"2001": ("aFAMILIE_ID", "aFAMTYPE", "faik2001.csv"),
                   "2002": ("bFAMILIE_ID", "bFAMTYPE", "faik2002.csv"),
                   "2003": ("cFAMILIE_ID", "cFAMTYPE", "faik2003.csv")}


def test_a_late_file_with_an_old_time_is_landed(spark, tmp_path):
    import os
    import time
    src, out, ckpt = tmp_path / "src", tmp_path / "out", tmp_path / "ckpt"
    src.mkdir()
    spec = REGISTERS["ras"]
    _file(src, "ras2001.parquet", 3)
    assert land_available_now(spark, str(src), None, spec, str(out), str(ckpt)) == 3
    _file(src, "ras1999.parquet", 5)
    old = time.time() - 400 * 86400
    os.utime(src / "ras1999.parquet", (old, old))
    assert land_available_now(spark, str(src), None, spec, str(out), str(ckpt)) == 5
    assert read_landed(spark, str(out), spec).count() == 8


def test_batch_and_incremental_landing_share_a_table(spark, tmp_path):
    from regcurate.plans.pipeline import land
    dated, out = tmp_path / "grund", str(tmp_path / "out")
    dated.mkdir()
    regs = {"ras": REGISTERS["ras"]}
    count = lambda: read_landed(spark, out + "/stage1/ras", REGISTERS["ras"]).count()
    _file(dated, "ras2001.parquet", 3)
    land(spark, str(dated), None, out, registers=regs, incremental=True)
    _file(dated, "ras2002.parquet", 2)
    land(spark, str(dated), None, out, registers=regs)
    assert count() == 5
    _file(dated, "ras2003.parquet", 4)
    land(spark, str(dated), None, out, registers=regs, incremental=True)
    assert count() == 9
