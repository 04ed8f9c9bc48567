"""Published versions, ledger landing and incremental curation."""

import pytest
from pyspark.sql import functions as F

from helpers import rows
from regcurate import plans
from regcurate.plans import incremental
from regcurate.sinks import writers
from regcurate.sinks.versions import Conflict, Published
from regcurate.sinks.writers import publish_curated, read_published, write_landed
from regcurate.sources import fs
from regcurate.sources.files import read_landed
from regcurate.specs.registers import REGISTERS

BEF = REGISTERS["bef"]


def _bef(spark, persons):
    """Landed bef rows: (file period, person, gender code)."""
    data = [tuple({"PNR": p, "KOEN": g, "FOED_DAG": f"19{k % 90 + 10}-01-01"}.get(c, c.lower())
                  for c in BEF.columns) + (f"bef{y}.sas7bdat", y)
            for k, (y, p, g) in enumerate(persons)]
    return spark.createDataFrame(data, ", ".join(
        f"{c} string" for c in (*BEF.columns, "source_file", "period")))


def _parts(spark, root):
    found = {}
    for write, _ in fs.children(spark, f"{root}/data"):
        for name, length, modified in fs.listing(spark, f"{root}/data/{write}"):
            if name.startswith("part-"):
                found[write, name] = (length, modified)
    return found


# --- versions -------------------------------------------------------------------

def test_failed_write_leaves_the_old_table_with_its_sidecar(spark, tmp_path, monkeypatch):
    root, old = str(tmp_path / "population"), _bef(spark, [("1990", "a", "1"), ("1991", "b", "2")])
    publish_curated("population", {"bef": old}, root)
    more = old.unionByName(_bef(spark, [("1992", "c", "1"), ("1992", "bad", "9")]))
    broken = more.withColumn("KOEN", F.when(F.col("PNR") == "bad", F.raise_error("broken file"))
                             .otherwise(F.col("KOEN"))).repartition(4)
    with pytest.raises(Exception, match="broken file"):
        publish_curated("population", {"bef": broken}, root)
    df, side = read_published(spark, "population", root)
    assert (df.count(), side["size"]) == (2, 2)
    # all data written, the manifest not
    with monkeypatch.context() as m:
        m.setattr(writers.Published, "publish", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish_curated("population", {"bef": more}, root)
    df, side = read_published(spark, "population", root)
    assert (df.count(), side["size"]) == (2, 2)
    publish_curated("population", {"bef": more}, root)
    df, side = read_published(spark, "population", root)
    assert (df.count(), side["size"]) == (4, 4)
    pinned, side = read_published(spark, "population", root, version=1)
    assert (pinned.count(), side["size"]) == (2, 2)
    table = Published(spark, root)
    assert table.versions() == [1, 2]
    assert len(table.clean_up(keep=1)) >= 2                    # version 1, the unpublished write
    assert table.versions() == [2] and read_published(spark, "population", root)[0].count() == 4


def test_second_writer_of_a_version_gets_a_conflict(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    first = table.publish(None, [], {"size": 1})
    table.publish(first, [], {"size": 2})
    with pytest.raises(Conflict):
        table.publish(first, [], {"size": 3})
    assert table.manifest().sidecar == {"size": 2}


def test_partition_values_survive_the_path(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([("x", "a/b c=1"), ("y", "0001")], "v string, k string")
    segments = table.write(df, 1, partition_by=["k"])
    assert sorted(s.keys["k"] for s in segments) == ["0001", "a/b c=1"]
    assert rows(table.read(segments, df.schema)) == rows(df)
    assert table.read([], df.schema, at="_at").columns == ["v", "k", "_at"]


# --- population -----------------------------------------------------------------

def _refreshed(spark, root):
    table = Published(spark, root)
    return incremental.live_population(table, table.manifest())


def test_take_over_and_untouched_persons(spark, tmp_path):
    root = str(tmp_path / "population")
    late = [("2000", "a", "1"), ("2000", "b", "2"), ("2000", "b", "1"), ("2001", "c", "1")]
    early = [("1990", "b", "1"), ("1990", "d", "2"), ("1990", "", "1")]
    between = [("1995", "b", "2"), ("1995", "a", "2"), ("2002", "a", "1"), ("2002", "e", "1")]
    deliveries = [late, early, between]
    seen, before = [], {}
    for k, delivery in enumerate(deliveries):
        seen += delivery
        landed = _bef(spark, seen)
        files = {f"bef{y}.sas7bdat" for y, *_ in delivery}
        state = incremental.refresh_population(landed, root, files)
        want = plans.population.build(landed)
        got = _refreshed(spark, root)
        assert rows(got, "person_id", "source_file", "gender") == \
            rows(want, "person_id", "source_file", "gender")
        bounds = plans.population.bounds_input(landed).agg(F.min("born_at"), F.max("born_at")).first()
        assert state.sidecar["size"] == want.count()
        assert tuple(state.sidecar["period"].values()) == tuple(bounds)
        now = _parts(spark, root)
        assert {p: now[p] for p in before} == before           # nothing rewritten
        before = now
    # the second delivery wrote the rows of b and d only
    table = Published(spark, root)
    data = [s for s in table.manifest().of("data") if s.version == 2]
    schema = incremental._strings(*plans.population.SPEC.names)
    assert {r.person_id for r in table.read(data, schema).collect()} == {"b", "d"}
    won = [s.stats for s in table.manifest().of("won")]
    assert won == [{"taken": 0, "new": 3}, {"taken": 1, "new": 1}, {"taken": 1, "new": 1}]
    assert incremental.refresh_population(_bef(spark, seen), root, files).version == 3   # no news
    want = rows(_refreshed(spark, root))
    compact = incremental.compact_population(table)
    assert len(compact.segments) == 1 and rows(_refreshed(spark, root)) == want


def test_corrected_emptied_and_withdrawn_files(spark, tmp_path):
    root = str(tmp_path / "population")
    state = [("1990", "a", "1"), ("1990", "b", "2"), ("1991", "a", "2"), ("1991", "c", "1"),
             ("1992", "b", "1"), ("1992", "d", "2"), ("1993", "b", "2")]
    incremental.refresh_population(_bef(spark, state), root,
                                   {f"bef{y}.sas7bdat" for y, *_ in state})
    steps = [
        ([("1990", "a", "2"), ("1990", "x", "1")], "1990"),     # corrected: b falls to 1992
        ([], "1992"),                                           # emptied or withdrawn: b to 1993
        ([("1992", "b", "9"), ("1992", "d", "1")], "1992"),     # back again
        ([("1989", "c", "1")], "1989"),
    ]
    for new, year in steps:
        state = [r for r in state if r[0] != year] + new
        landed = _bef(spark, state)
        name = {f"bef{year}.sas7bdat"}
        incremental.refresh_population(landed, root, name, name)
        assert rows(_refreshed(spark, root), "person_id", "source_file", "gender") == \
            rows(plans.population.build(landed), "person_id", "source_file", "gender")
        assert Published(spark, root).manifest().sidecar["size"] == \
            plans.population.build(landed).count()


def test_a_person_with_most_rows_is_taken_over_whole(spark, tmp_path):
    root = str(tmp_path / "population")
    rows_ = [("2000", "hot", str(k % 2 + 1)) for k in range(3000)] + [("2000", "p", "1")]
    incremental.refresh_population(_bef(spark, rows_), root, {"bef2000.sas7bdat"})
    rows_ += [("1999", "hot", "1")] * 2000
    state = incremental.refresh_population(_bef(spark, rows_), root, {"bef1999.sas7bdat"})
    assert state.sidecar["size"] == _refreshed(spark, root).count() == 2001


# --- diagnoses -------------------------------------------------------------------

def _diagnosis_inputs(spark, rows_of):
    """Landed register stand-ins: rows_of[register] = [(period, record id)]."""
    out = {}
    for register, data in rows_of.items():
        spec = REGISTERS[register]
        key = {"lpr_adm": "RECNUM", "lpr_diag": "RECNUM", "psyk_adm": "RECNUM",
               "psyk_diag": "RECNUM", "patient_icd8": "PAT_SEQ"}[register]
        out[register] = spark.createDataFrame(
            [tuple({key: rid, "PNR": f"p{rid}", "CPRNR": f"p{rid}"}.get(c, f"{c}{n}")
                   for c in spec.columns) + (f"{register}{p if p != '0' else ''}.sas7bdat", p)
             for n, (p, rid) in enumerate(data)],
            ", ".join(f"{c} string" for c in (*spec.columns, "source_file", "period")))
    return out


def test_only_touched_partitions_are_joined_again(spark, tmp_path):
    root, base = str(tmp_path / "diagnoses"), str(tmp_path / "stage1")
    state = {"lpr_adm": [("1990", "1"), ("1990", "2"), ("1991", "1")],
             "lpr_diag": [("1990", "1"), ("1990", "1"), ("1992", "7")],
             "psyk_adm": [("1990", "1")], "psyk_diag": [("1990", "1"), ("1990", "")],
             "patient_icd8": [("0", "5"), ("0", "5"), ("0", "6")]}

    def landed():
        for register, df in _diagnosis_inputs(spark, state).items():
            write_landed(df, f"{base}/{register}")
        return {r: read_landed(spark, f"{base}/{r}", REGISTERS[r]) for r in state}

    def check(table):
        inputs = landed()
        want = plans.diagnoses.build(inputs)
        found = table.manifest()
        assert rows(incremental.published_diagnoses(table, found)) == rows(want)
        assert found.sidecar["size"] == want.count()
        bounds = plans.diagnoses.bounds_input(inputs).agg(
            F.min("starts_at"), F.max("ends_at")).first()
        assert tuple(found.sidecar["period"].values()) == tuple(bounds)

    table = Published(spark, root)
    inputs = landed()
    incremental.refresh_diagnoses(inputs, root, {(r, p) for r, xs in state.items()
                                                 for p, _ in xs}, spark)
    check(table)
    kept = {(s.keys["register"], s.keys["period"]): s.path for s in table.manifest().segments}
    assert set(kept) == {("lpr2", "1990"), ("pcrr3", "1990"), ("pcrr1", "0")}
    # the diagnoses of 1991 come after their records; 1990 is corrected
    state["lpr_diag"] = [("1991", "1"), ("1990", "2"), ("1992", "7")]
    parts = {("lpr_diag", "1991"), ("lpr_diag", "1990")}
    inputs = landed()
    cut = incremental.pruned(inputs, incremental.touched(parts))
    assert set(cut) == {"lpr_adm", "lpr_diag"}
    plan = cut["lpr_adm"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [period" in plan and "1990" in plan and "1991" in plan
    read = {r[0] for r in cut["lpr_diag"].select(F.input_file_name()).distinct().collect()}
    assert read and all("period=1991" in f or "period=1990" in f for f in read)
    incremental.refresh_diagnoses(inputs, root, parts, spark)
    check(table)
    now = {(s.keys["register"], s.keys["period"]): s for s in table.manifest().segments}
    assert now["pcrr3", "1990"].path == kept["pcrr3", "1990"]
    assert now["pcrr1", "0"].path == kept["pcrr1", "0"]
    assert now["lpr2", "1990"].version == now["lpr2", "1991"].version == 2


# --- ledger and the whole ----------------------------------------------------------

def _put(spark, folder, name, df, fmt="parquet"):
    out = f"{folder}/_staging-{name}"
    df.coalesce(1).write.mode("overwrite").option("header", "true").format(fmt).save(out)
    part = next(n for n, _ in fs.children(spark, out) if n.startswith("part-"))
    fs.delete(spark, f"{folder}/dated/{name}")
    fs.move(spark, f"{out}/{part}", f"{folder}/dated/{name}")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_refresh_follows_the_folders(spark, tmp_path, fmt):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    registers = {r: REGISTERS[r] for r in ("bef", "ind")}
    ind = REGISTERS["ind"]

    def bef(persons):
        return _bef(spark, [("x", p, g) for p, g in persons]).drop("source_file", "period")

    def income(people):
        return spark.createDataFrame([tuple({"PNR": p}.get(c, "1") for c in ind.columns)
                                      for p in people], ", ".join(f"{c} string" for c in ind.columns))

    def refresh():
        return incremental.refresh(spark, f"{folder}/dated", f"{folder}/none", out, fmt, registers)

    def persons():
        df, side = incremental.read_refreshed(spark, out, "population")
        got = rows(df, "person_id", "source_file")
        assert side["size"] == len(got)
        return got

    _put(spark, folder, f"bef1991.{fmt}", bef([("a", "1"), ("b", "1")]), fmt)
    _put(spark, folder, f"bef1992.{fmt}", bef([("c", "1")]), fmt)
    _put(spark, folder, f"ind1991.{fmt}", income(["a", "b"]), fmt)
    first = refresh()
    assert first["stage1"]["bef"]["added"] == [f"bef1991.{fmt}", f"bef1992.{fmt}"]
    assert first["stage2"] == {"population": {"version": 1, "rows": 3},
                               "income": {"version": 1, "rows": 2}}
    assert refresh() == {"stage1": {}, "stage2": {}}
    # the same bytes with a new time are the same file
    fs.set_modified(spark, f"{folder}/dated/bef1992.{fmt}", 1_000_000_000_000)
    assert refresh() == {"stage1": {}, "stage2": {}}
    # added before, corrected, emptied, withdrawn
    _put(spark, folder, f"bef1990.{fmt}", bef([("b", "2"), ("z", "1")]), fmt)
    _put(spark, folder, f"bef1991.{fmt}", bef([("a", "2"), ("c", "1")]), fmt)
    fs.delete(spark, f"{folder}/dated/ind1991.{fmt}")
    second = refresh()
    assert second["stage1"]["bef"] == {"added": [f"bef1990.{fmt}"],
                                       "corrected": [f"bef1991.{fmt}"], "emptied": [],
                                       "withdrawn": []}
    assert second["stage1"]["ind"]["withdrawn"] == [f"ind1991.{fmt}"]
    assert persons() == [("a", f"bef1991.{fmt}"), ("b", f"bef1990.{fmt}"),
                         ("c", f"bef1991.{fmt}"), ("z", f"bef1990.{fmt}")]
    assert incremental.read_refreshed(spark, out, "income")[0].count() == 0
    _put(spark, folder, f"bef1990.{fmt}", bef([]), fmt)
    assert refresh()["stage1"]["bef"]["emptied"] == [f"bef1990.{fmt}"]
    assert persons() == [("a", f"bef1991.{fmt}"), ("c", f"bef1991.{fmt}")]
    _put(spark, folder, f"bef1990.{fmt}", bef([("q", "1")]), fmt)
    fs.delete(spark, f"{folder}/dated/bef1991.{fmt}")
    refresh()
    assert persons() == [("c", f"bef1992.{fmt}"), ("q", f"bef1990.{fmt}")]
    old, side = incremental.read_refreshed(spark, out, "population", version=1)
    assert old.count() == side["size"] == 3                     # a pinned version


def test_refreshed_diagnoses_are_written_by_the_tasks_that_join_them(spark, tmp_path, monkeypatch):
    rec = spark.createDataFrame([(str(i % 4), f"p{i}", "1", "1990-01-01", None, "lpr_adm1990.sas7bdat", p)
                                 for i, p in enumerate(["1990"] * 5 + [None])],
                                "RECNUM string, PNR string, C_PATTYPE string, D_INDDTO string, "
                                "D_UDDTO string, source_file string, period string")
    diag = spark.createDataFrame([(str(i % 4), f"DF{i}", "A", "lpr_diag1990.sas7bdat", p)
                                  for i, p in enumerate(["1990"] * 5 + [None])],
                                 "RECNUM string, C_DIAG string, C_DIAGTYPE string, "
                                 "source_file string, period string")
    written, write = [], Published.write
    monkeypatch.setattr(Published, "write", lambda self, df, *a, **kw: written.append(df)
                        or write(self, df, *a, **kw))
    inputs, root = {"lpr_adm": rec, "lpr_diag": diag}, str(tmp_path / "published")
    found = incremental.refresh_diagnoses(inputs, root, {("lpr_adm", "1990")}, spark)
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Rebalance" not in plan and "Repartition" not in plan
    assert rows(incremental.published_diagnoses(Published(spark, root), found)) == rows(
        plans.diagnoses.build({r: df.where("period = '1990'") for r, df in inputs.items()}))
    assert found.sidecar["size"] == 7
