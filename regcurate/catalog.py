"""Query catalogue: every table and operator as a ``(spark, sf_dir) ->
DataFrame`` callable over the register stand-ins, and, for each, an
independent DuckDB SQL oracle over the same stand-in views.

The oracles are written in a different form from the Spark plans where the
operator is the point: first-file-wins as a correlated ``min``, the five
register joins as five separate joins ``UNION ALL``, reconciliation as a full
outer join.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import plans
from .functions.columns import non_empty
from .operators import profile
from .operators.dedup import file_ordinals, rows_in_first_file
from .operators.landing import land_register
from .plans.pipeline import land
from .session import ensure_checkpoint_dir, fine_scans
from .sinks.writers import URN, read_json, sorted_for_write, write_curated
from .sources import fs
from .sources.files import land_folder, read_landed, register_files, rows_by_file
from .sources.fixtures import (duckdb_with, register_view, register_views, stage_all,
                               stage_extracts)
from .specs.curated import DIAGNOSIS_PAIRS, TABLES
from .specs.registers import AKM_AS_SHIPPED, REGISTERS, RegisterSpec
from .streaming.landing import land_available_now

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def _inputs(spark: SparkSession, sf_dir: str, table: str) -> dict[str, DataFrame]:
    return register_views(spark, sf_dir, plans.PLANS[table].INPUTS)


def _curated(table: str, **kw) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plans.build(table, _inputs(spark, sf_dir, table), **kw)
    q.__doc__ = f"Curated table {table}."
    return q


def _land(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return land_register(register_view(spark, sf_dir, name), REGISTERS[name])
    q.__doc__ = f"Landed register {name}: spec columns, source_file, period."
    return q


def q_land_akm_sparse(spark, sf_dir):
    """akm landed with the shipped (ras-shaped) spec: tolerant projection
    keeps PNR and gives typed nulls for the columns the files lack."""
    return land_register(register_view(spark, sf_dir, "akm"), AKM_AS_SHIPPED)


def q_population_unique(spark, sf_dir):
    """Exactly one row per person: ``min(struct)`` aggregate, partial merging."""
    return plans.population.build_unique(register_view(spark, sf_dir, "bef"))


def q_population_window(spark, sf_dir):
    """Population by ``rank`` over ``partitionBy(person_id)``: one shuffle of
    the rows, for registers in which no person has many."""
    return plans.population.build_window(register_view(spark, sf_dir, "bef"))


_JOINED = "n_records * n_diagnoses"       # joined rows of a key


def q_diagnoses_by_register(spark, sf_dir):
    """Joined rows per register, from per-key counts: no join."""
    totals = plans.diagnoses.counts(_inputs(spark, sf_dir, "diagnoses"))
    return totals.groupBy("register").agg(F.sum(F.expr(_JOINED)).alias("n")).where("n > 0")


def q_diagnoses_pair_profile(spark, sf_dir):
    """Per register pair: filtered records, filtered diagnoses, joined rows, all
    from per-key counts; a pair without rows is absent."""
    totals = plans.diagnoses.counts(_inputs(spark, sf_dir, "diagnoses"))
    return totals.groupBy("register").agg(
        F.sum("n_records").alias("records"), F.sum("n_diagnoses").alias("diagnoses"),
        F.sum(F.expr(_JOINED)).alias("joined"))


def q_count_by_patient_kind(spark, sf_dir):
    """Joined rows per patient kind, from per-key counts: no join."""
    totals = plans.diagnoses.counts(_inputs(spark, sf_dir, "diagnoses"), by=("patient_kind",))
    return totals.groupBy("patient_kind").agg(F.sum(F.expr(_JOINED)).alias("n")).where("n > 0")


def q_income_sorted(spark, sf_dir):
    """Income in its declared output order (range-partitioned, sorted within
    partitions) -- the form the sorted sink writes."""
    return sorted_for_write(plans.income.build(register_view(spark, sf_dir, "ind")),
                            TABLES["income"].sorted_by)


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the session's shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_land_available_now(spark, sf_dir):
    """Incremental landing end to end: the bef extracts arrive as files in two
    deliveries, the second with modification times a year back; each delivery is
    landed by the available-now stream, a third run adds nothing, and the landed
    table is returned."""
    base, spec = _scratch(spark, "available-now"), REGISTERS["bef"]
    ready = stage_extracts(register_view(spark, sf_dir, "bef"), spec, base + "/ready")
    args = (spark, base + "/dated", None, spec, base + "/out", base + "/ckpt")
    for part in (ready[::2], ready[1::2]):
        for path in part:
            to = f"{base}/dated/{path.rsplit('/', 1)[1]}"
            fs.move(spark, path, to)
            if part[0] != ready[0]:
                fs.set_modified(spark, to, int((time.time() - 365 * 86400) * 1000))
        if part and not land_available_now(*args):
            raise RuntimeError("a delivery was not landed")
    again = land_available_now(*args)
    if again:
        raise RuntimeError(f"rerun of the available-now landing added {again} rows")
    return read_landed(spark, base + "/out", spec)


def q_land_files(spark, sf_dir):
    """ras landed from files: yearly extracts and an undated copy, told apart by
    name from a foreign file and from another register's, provenance from the
    file names."""
    base, spec, own = _scratch(spark, "land-files"), REGISTERS["ras"], fine_scans(spark)
    stage_extracts(register_view(own, sf_dir, "ras"), spec, base, parts=True)
    stage_extracts(register_view(own, sf_dir, "akm"), REGISTERS["akm"], base, parts=True)
    foreign = RegisterSpec("zzz", spec.columns)
    stage_extracts(register_view(own, sf_dir, "ras").withColumn(
        "source_file", F.lit("zzz2001.sas7bdat")), foreign, base, parts=True)
    landed = land(spark, base + "/dated", base + "/undated", base + "/out",
                  registers={"ras": spec})
    return read_landed(spark, landed["ras"], spec)


def q_land_csv_drift(spark, sf_dir):
    """faik landed from CSV files in two layouts: odd years have the columns in
    reverse, one column more and NA for missing values; even years have the
    spec's order and leave missing values empty. Empty strings are quoted."""
    base, spec = _scratch(spark, "land-csv"), REGISTERS["faik"]
    faik = spark.sql(_FAIK_DRIFT_SQL, faik=register_view(spark, sf_dir, "faik"))
    odd = F.col("source_file").rlike("[13579][.]")
    stage_extracts(faik.where(odd).select(*reversed(spec.columns), F.lit("x").alias("EXTRA"),
                                          "source_file"),
                   spec, base + "/odd", "csv", header="true", nullValue="NA")
    stage_extracts(faik.where(~odd), spec, base + "/even", "csv", header="true", nullValue="")
    for side in ("odd", "even"):
        for name, _ in fs.children(spark, f"{base}/{side}/dated"):
            fs.move(spark, f"{base}/{side}/dated/{name}", f"{base}/dated/{name}")
    return land_folder(spark, base + "/dated", spec, fmt="csv")


_FAIK_DRIFT_SQL = """SELECT FAMILIE_ID, CASE WHEN FAMTYPE = '3' THEN NULL ELSE FAMTYPE END AS FAMTYPE,
 FAMINDKOMSTIALT_13, FAMLOENMV_13, FAMERHVERVSINDK_13, FAMOFF_OVERFORSEL_13, FAMPRIVAT_PENSION_13,
 CASE WHEN FAMTYPE = '2' THEN '' ELSE FAMRESTINDK_13 END AS FAMRESTINDK_13, FAMSKATTOT_13, source_file
FROM {faik}"""


def q_prescriptions_partitioned(spark, sf_dir):
    """Prescriptions as the category sink writes them, read back by folder."""
    path = _scratch(spark, "prescriptions") + "/prescriptions"
    write_curated("prescriptions", _inputs(spark, sf_dir, "prescriptions"), path)
    return spark.read.schema(StructType([StructField(n, StringType()) for n in (
        *TABLES["prescriptions"].names, "atc_category")])).parquet(path)


def _columns_told() -> list[dict]:
    """What the sidecars say about columns, without the written table's size."""
    return [{"table_name": t.key, "column_index": i, "column_name": c.name, "title": c.title,
             "description": c.description, "examples": "|".join(c.examples), "type": c.type,
             "nullable": c.nullable, "format": c.format, "enum": "|".join(c.enum),
             "lineage": "|".join(URN.format(register=o.split(":")[0], column=o.split(":")[1])
                                 for o in c.origin)}
            for t in TABLES.values() for i, c in enumerate(t.columns)]


def q_sidecars(spark, sf_dir):
    """Every curated table written, and its sidecar read back: one row per table
    and column."""
    base, rows = _scratch(spark, "sidecars"), []
    for name in plans.PLANS:
        write_curated(name, _inputs(spark, sf_dir, name), f"{base}/{name}")
        doc = read_json(spark, f"{base}/{name}_metadata.json")
        for column, c in doc["columns"].items():
            rows.append((doc["key"], c["index"], column, c["title"], c["description"],
                         "|".join(c["examples"]), c["type"], c["nullable"], c.get("format"),
                         "|".join(e["value"] for e in c.get("enum", ())),
                         "|".join(r["target"] for r in c.get("relations", ())),
                         doc["size"], doc["period"]["first"], doc["period"]["last"]))
    return spark.createDataFrame(rows, (
        "table_name string, column_index int, column_name string, title string, "
        "description string, examples string, type string, nullable boolean, format string, "
        "enum string, lineage string, rows long, first string, last string"))


def q_sorted_order(spark, sf_dir):
    """Every table with a declared order written in it: rows, and how many stand
    below their predecessor across the files as read in name order."""
    base, out = _scratch(spark, "sorted"), []
    for name, spec in TABLES.items():
        if not spec.sorted_by:
            continue
        write_curated(name, _inputs(spark, sf_dir, name), f"{base}/{name}", sort=True)
        out.append(profile.out_of_order(spark.read.parquet(f"{base}/{name}"), spec.sorted_by)
                   .select(F.lit(name).alias("table_name"), "rows", "out_of_order"))
    return profile.union_rows(out)


def q_prescriptions_by_category(spark, sf_dir):
    p = plans.prescriptions.build(register_view(spark, sf_dir, "lmdb"))
    return profile.group_count(p, "atc_category")


def _count_by(table: str, column: str) -> Query:
    def q(spark, sf_dir):
        return profile.group_count(plans.build(table, _inputs(spark, sf_dir, table)), column)
    q.__doc__ = f"Group count of {table}.{column}."
    return q


def q_family_size(spark, sf_dir):
    return profile.family_size(plans.population.build(register_view(spark, sf_dir, "bef")))


def q_coverage(spark, sf_dir):
    """Per curated table: first and last period value and rows. Population bounds
    are taken before the dedup, diagnoses bounds on the records; their rows are
    counted per key, without building the table."""
    regs = register_views(spark, sf_dir, sorted({r for m in plans.PLANS.values()
                                                 for r in m.INPUTS}))
    rows = []
    for name in plans.PLANS:
        first, last = TABLES[name].period_columns
        if name == "population":
            cands = plans.bounds_input(name, regs)
            rows.append(profile.coverage_of_parts(
                name, cands, first, last, rows_in_first_file(cands, "person_id"),
                F.col("_rows")))
        elif name == "diagnoses":
            rows.append(profile.coverage_of_parts(
                name, plans.bounds_input(name, regs), first, last,
                plans.diagnoses.counts(regs), F.expr(_JOINED)))
        else:
            rows.append(profile.coverage_row(name, plans.build(name, regs), first, last))
    return profile.union_rows(rows)


EMPTY_FILE = "bef190012.parquet"


def q_file_inventory(spark, sf_dir):
    """Every register as extract files, an empty file and a foreign one among
    them: the files by listing, their rows by file."""
    base = _scratch(spark, "inventory")
    stage_all(fine_scans(spark), sf_dir, base)
    bef = register_view(spark, sf_dir, "bef").drop("source_file")
    for name in (EMPTY_FILE, "zzz2001.parquet"):
        bef.limit(0).coalesce(1).write.parquet(f"{base}/staging/{name}")
        part = next(n for n, _ in fs.children(spark, f"{base}/staging/{name}")
                    if n.startswith("part-"))
        fs.move(spark, f"{base}/staging/{name}/{part}", f"{base}/dated/{name}")
    files = [register_files(spark, f"{base}/{side}", side == "dated")
             .select("dataset", "period", "file_name").distinct() for side in ("dated", "undated")]
    rows = [rows_by_file(spark, f"{base}/{side}") for side in ("dated", "undated")]
    return profile.file_inventory(profile.union_rows(files), profile.union_rows(rows))


_KEYS = {"income": "PNR", "family_income": "FAMILIE_ID", "education": "PNR", "employment": "PNR"}


def q_rows_per_file(spark, sf_dir):
    """Landed against curated rows per source file, for all eight tables
    (diagnoses: per record file). Tables that only filter take one scan; the
    others are counted per key."""
    out = []
    for name in plans.PLANS:
        regs = _inputs(spark, sf_dir, name)
        if name == "population":
            cands = plans.bounds_input(name, regs)
            first = rows_in_first_file(cands, "person_id").groupBy("_ordinal") \
                .agg(F.sum("_rows").alias("curated_rows"))
            curated = first.join(file_ordinals(cands), "_ordinal").select(
                F.col("_file").alias("source_file"), "curated_rows")
            out.append(profile.reconcile_counts(regs["bef"], curated, name))
        elif name == "diagnoses":
            landed = profile.union_rows(
                regs[sides["records"][0]].select("source_file")
                for sides in DIAGNOSIS_PAIRS.values())
            curated = plans.diagnoses.counts(regs, by=("record_source_file",)) \
                .where("n_records > 0").groupBy(F.col("record_source_file").alias("source_file")) \
                .agg(F.sum(F.expr(_JOINED)).alias("curated_rows"))
            out.append(profile.reconcile_counts(landed, curated, name))
        else:
            landed = profile.union_rows(r.select("source_file", *(
                [_KEYS[name]] if name in _KEYS else [])) for r in regs.values())
            kept = non_empty(_KEYS[name]) if name in _KEYS else F.lit(True)
            out.append(profile.rows_per_file(landed, kept, name))
    return profile.union_rows(out)


def q_contract_report(spark, sf_dir):
    """Violations of every declared contract; diagnoses are counted per key on
    the side a column comes from, without the join."""
    regs = register_views(spark, sf_dir, sorted({r for m in plans.PLANS.values()
                                                 for r in m.INPUTS}))
    diagnoses = plans.diagnoses
    return profile.union_rows(
        profile.joined_contract_report(
            TABLES[n], diagnoses.record_columns(),
            lambda r, d: diagnoses.counts(regs, record_sums=r, diagnosis_sums=d))
        if n == "diagnoses" else profile.contract_report(plans.build(n, regs), TABLES[n])
        for n in plans.PLANS)


QUERIES: dict[str, Query] = {}
for _n in REGISTERS:
    QUERIES[f"land_{_n}"] = _land(_n)
QUERIES["land_akm_sparse"] = q_land_akm_sparse
QUERIES["land_available_now"] = q_land_available_now
QUERIES["land_files"] = q_land_files
QUERIES["land_csv_drift"] = q_land_csv_drift
for _t in plans.PLANS:
    QUERIES[_t] = _curated(_t)
QUERIES.update({
    "population_unique": q_population_unique,
    "population_window": q_population_window,
    "diagnoses_by_register": q_diagnoses_by_register,
    "diagnoses_pair_profile": q_diagnoses_pair_profile,
    "income_sorted": q_income_sorted,
    "prescriptions_by_category": q_prescriptions_by_category,
    "prescriptions_partitioned": q_prescriptions_partitioned,
    "sidecars": q_sidecars,
    "sorted_order": q_sorted_order,
    "count_by_gender": _count_by("population", "gender"),
    "count_by_status_source": _count_by("employment", "status_source"),
    "count_by_tax_scope": _count_by("income", "tax_scope"),
    "count_by_patient_kind": q_count_by_patient_kind,
    "family_size": q_family_size,
    "coverage": q_coverage,
    "file_inventory": q_file_inventory,
    "rows_per_file": q_rows_per_file,
    "contract_report": q_contract_report,
})

# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------


def _period_sql(name: str) -> str:
    if not REGISTERS[name].dated:
        return "'0'"
    return (f"coalesce(nullif(regexp_extract(source_file, '^{name}([0-9]+)\\.[^./]+$', 1), ''),"
            " '0')")


def _land_sql(name: str, cols=None) -> str:
    present = set(REGISTERS[name].columns)
    cols = cols or REGISTERS[name].columns
    sel = ", ".join(c if c in present else f"CAST(NULL AS VARCHAR) AS {c}" for c in cols)
    return f"SELECT {sel}, source_file, {_period_sql(name)} AS period FROM {name}"


def _year_sql(dataset: str) -> str:
    return f"nullif(regexp_extract(source_file, '^{dataset}([0-9]+)\\.[^./]+$', 1), '')"


INCOME_SQL = f"""SELECT PNR AS person_id, {_year_sql('ind')} AS tax_year, OMFANG AS tax_scope,
 SKATTOT_13 AS tax_sum, BESKST13 AS income_main_source, ERHVERVSINDK_13 AS income_social_contrib,
 LOENMV_13 AS income_employment, OFF_OVERFORSEL_13 AS income_social,
 PRIVAT_PENSION_13 AS income_priv_pension, RESUINK_13 AS income_other, PERINDKIALT_13 AS income_sum,
 source_file FROM ind WHERE PNR <> ''"""

FAMILY_INCOME_SQL = f"""SELECT FAMILIE_ID AS family_id, FAMTYPE AS family_kind,
 {_year_sql('faik')} AS tax_year, FAMSKATTOT_13 AS tax_sum,
 FAMERHVERVSINDK_13 AS income_social_contrib, FAMLOENMV_13 AS income_employment,
 FAMOFF_OVERFORSEL_13 AS income_social, FAMPRIVAT_PENSION_13 AS income_priv_pension,
 FAMRESTINDK_13 AS income_other, FAMINDKOMSTIALT_13 AS income_sum, source_file
 FROM faik WHERE FAMILIE_ID <> ''"""

EDUCATION_SQL = """SELECT PNR AS person_id, HFAUDD AS kind, HFINSTNR AS institute, HF_KILDE AS source,
 HF_VFRA AS completed_at, source_file FROM udda WHERE PNR <> ''"""

# years are compared as text, as the source does
EMPLOYMENT_SQL = f"""SELECT person_id, year,
 CASE WHEN year <= '1993' THEN 'ARBSTIL' WHEN year >= '1994' AND year <= '1995' THEN 'NYARB'
      WHEN year >= '1996' AND year <= '2007' THEN 'SOCSTIL_KODE' ELSE 'SOC_STATUS_KODE'
      END AS status_source,
 CASE WHEN year <= '1993' THEN ARBSTIL WHEN year >= '1994' AND year <= '1995' THEN NYARB
      WHEN year >= '1996' AND year <= '2007' THEN SOCSTIL_KODE ELSE SOC_STATUS_KODE END AS status,
 CASE WHEN year < '1992' THEN 'BRANCHE_77' WHEN year >= '1992' AND year <= '2007'
      THEN 'BRANCHE_KODE' ELSE 'ARB_HOVED_BRA_DB07' END AS industry_source,
 CASE WHEN year < '1992' THEN BRANCHE_77 WHEN year >= '1992' AND year <= '2007'
      THEN BRANCHE_KODE ELSE ARB_HOVED_BRA_DB07 END AS industry,
 source_file
FROM (SELECT *, PNR AS person_id, {_year_sql('ras')} AS year FROM ras WHERE PNR <> '') t"""

POPULATION_CANDIDATES_SQL = """SELECT PNR AS person_id,
 CASE WHEN KOEN IS NULL THEN NULL WHEN KOEN = '1' THEN 'm' ELSE 'f' END AS gender,
 FOED_DAG AS born_at, FOEDREG_KODE AS birthplace_id, MOR_ID AS mother_id, FAR_ID AS father_id,
 FAMILIE_ID AS family_id, source_file FROM bef WHERE PNR <> ''"""

POPULATION_SQL = f"""SELECT * FROM ({POPULATION_CANDIDATES_SQL}) p
WHERE p.source_file = (SELECT min(b.source_file) FROM bef b WHERE b.PNR = p.person_id)"""

POPULATION_UNIQUE_SQL = f"""SELECT person_id, gender, born_at, birthplace_id, mother_id, father_id,
 family_id, source_file FROM (
 SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY source_file NULLS FIRST,
   gender NULLS FIRST, born_at NULLS FIRST, birthplace_id NULLS FIRST, mother_id NULLS FIRST,
   father_id NULLS FIRST, family_id NULLS FIRST) AS rn
 FROM ({POPULATION_CANDIDATES_SQL}) c) t WHERE rn = 1"""


def _diag_pair_sql(pair: str) -> str:
    rreg, rc = DIAGNOSIS_PAIRS[pair]["records"]
    dreg, dc = DIAGNOSIS_PAIRS[pair]["diagnoses"]
    period = ("r_period = d_period" if REGISTERS[rreg].dated or REGISTERS[dreg].dated
              else "TRUE")
    rper = (f"regexp_extract(source_file, '([0-9]+)\\.sas7bdat$', 1)"
            if REGISTERS[rreg].dated else "'0'")
    dper = (f"regexp_extract(source_file, '([0-9]+)\\.sas7bdat$', 1)"
            if REGISTERS[dreg].dated else "'0'")
    return f"""SELECT r.person_id, r.record_id, r.patient_kind, r.starts_at, r.ends_at,
 d.diagnosis_id, d.diagnosis_kind, r.record_source_file, d.diagnosis_source_file, '{pair}' AS register
FROM (SELECT {rc['person_id']} AS person_id, {rc['record_id']} AS record_id,
             {rc['patient_kind']} AS patient_kind, {rc['starts_at']} AS starts_at,
             {rc['ends_at']} AS ends_at, source_file AS record_source_file, {rper} AS r_period
      FROM {rreg} WHERE {rc['record_id']} <> '' AND {rc['person_id']} <> '') r
JOIN (SELECT {dc['record_id']} AS record_id, {dc['diagnosis_id']} AS diagnosis_id,
             {dc['diagnosis_kind']} AS diagnosis_kind, source_file AS diagnosis_source_file,
             {dper} AS d_period
      FROM {dreg} WHERE {dc['record_id']} <> '') d
  ON r.record_id = d.record_id AND {period}"""


DIAGNOSES_ALL_SQL = "\nUNION ALL\n".join(_diag_pair_sql(p) for p in DIAGNOSIS_PAIRS)
DIAGNOSES_SQL = f"""SELECT person_id, record_id, patient_kind, starts_at, ends_at, diagnosis_id,
 diagnosis_kind, record_source_file, diagnosis_source_file FROM ({DIAGNOSES_ALL_SQL}) x"""

DEATHS_SQL = """SELECT PNR AS person_id, D_DODSDTO AS deceased_at, C_DODSMAADE AS mode,
 C_DOD1 AS cause_1_icd_id, C_DOD2 AS cause_2_icd_id, C_DOD3 AS cause_3_icd_id,
 C_DOD4 AS cause_4_icd_id, source_file FROM dodsaars
UNION ALL
SELECT PNR, D_DODSDATO, C_DODSMAADE, C_DOD_1A, C_DOD_1B, C_DOD_1C, C_DOD_1D, source_file
FROM dodsaasg"""

PRESCRIPTIONS_SQL = """SELECT PNR AS person_id, ATC AS atc_id, IBNR AS ibnr_id, EKSD AS dispensed_at,
 VOLUME AS volume, VOLTYPECODE AS volume_type_code, PACKSIZE AS pack_size, STRNUM AS strength,
 STRUNIT AS strength_unit, DOSFORM AS dosage_form, source_file,
 CASE WHEN ATC IS NULL OR ATC = '' THEN '_none' ELSE left(ATC, 1) END AS atc_category
FROM lmdb"""

CURATED_SQL = {
    "income": (INCOME_SQL, ("ind",)),
    "family_income": (FAMILY_INCOME_SQL, ("faik",)),
    "education": (EDUCATION_SQL, ("udda",)),
    "employment": (EMPLOYMENT_SQL, ("ras",)),
    "population": (POPULATION_SQL, ("bef",)),
    "diagnoses": (DIAGNOSES_SQL, plans.diagnoses.INPUTS),
    "deaths": (DEATHS_SQL, ("dodsaars", "dodsaasg")),
    "prescriptions": (PRESCRIPTIONS_SQL, ("lmdb",)),
}


def _with(views) -> str:
    return duckdb_with(sorted(set(views)))


def _oracle_coverage_body() -> str:
    parts = []
    for name, (sql, _) in CURATED_SQL.items():
        first, last = TABLES[name].period_columns
        if name == "population":
            parts.append(f"""SELECT 'population' AS table_name,
 (SELECT min(born_at) FROM ({POPULATION_CANDIDATES_SQL}) c) AS first,
 (SELECT max(born_at) FROM ({POPULATION_CANDIDATES_SQL}) c) AS last,
 (SELECT count(*) FROM ({sql}) p) AS rows""")
        elif name == "diagnoses":
            rec = "\nUNION ALL\n".join(
                f"SELECT {rc['starts_at']} AS s, {rc['ends_at']} AS e FROM {rreg} "
                f"WHERE {rc['record_id']} <> '' AND {rc['person_id']} <> ''"
                for rreg, rc in (DIAGNOSIS_PAIRS[p]["records"] for p in DIAGNOSIS_PAIRS))
            parts.append(f"""SELECT 'diagnoses' AS table_name,
 (SELECT min(s) FROM ({rec}) r) AS first, (SELECT max(e) FROM ({rec}) r) AS last,
 (SELECT count(*) FROM ({sql}) d) AS rows""")
        else:
            parts.append(f"SELECT '{name}' AS table_name, min({first}) AS first, "
                         f"max({last}) AS last, count(*) AS rows FROM ({sql}) t")
    return "\nUNION ALL\n".join(parts)


def _oracle_coverage() -> str:
    return _with({r for _, regs in CURATED_SQL.values() for r in regs}) + _oracle_coverage_body()


_AS_FILE = "replace(source_file, '.sas7bdat', '.parquet')"


def _landed_files_sql(name: str) -> str:
    """A landed register whose extracts are Parquet files."""
    sel = ", ".join(REGISTERS[name].columns)
    return f"SELECT {sel}, {_AS_FILE} AS source_file, period FROM ({_land_sql(name)}) l"


def _oracle_file_inventory() -> str:
    parts = [f"SELECT '{n}' AS dataset, period, {_AS_FILE} AS source_file, 1 AS n "
             f"FROM ({_land_sql(n)}) l" for n in REGISTERS]
    parts.append(f"SELECT 'bef', '190012', '{EMPTY_FILE}', 0")
    return _with(REGISTERS) + f"""SELECT dataset, count(DISTINCT source_file) AS n_files,
 min(period) AS first_period, max(period) AS last_period,
 string_agg(DISTINCT period, ',' ORDER BY period) AS periods,
 string_agg(DISTINCT source_file, ',' ORDER BY source_file) AS source_files, sum(n)::BIGINT AS rows
FROM ({' UNION ALL '.join(parts)}) t GROUP BY dataset"""


def _oracle_rows_per_file() -> str:
    parts, views = [], set()
    for name, (sql, regs) in CURATED_SQL.items():
        views |= set(regs)
        file, landed = "source_file", regs
        if name == "diagnoses":
            file = "record_source_file"
            landed = [s["records"][0] for s in DIAGNOSIS_PAIRS.values()]
        raw = " UNION ALL ".join(f"SELECT source_file FROM {r}" for r in landed)
        parts.append(f"""SELECT '{name}' AS table_name, coalesce(l.source_file, c.source_file) AS source_file,
 coalesce(l.n, 0) AS landed_rows, coalesce(c.n, 0) AS curated_rows,
 coalesce(l.n, 0) - coalesce(c.n, 0) AS dropped_rows
FROM (SELECT source_file, count(*) AS n FROM ({raw}) r GROUP BY source_file) l
FULL OUTER JOIN (SELECT {file} AS source_file, count(*) AS n FROM ({sql}) x GROUP BY {file}) c
  ON l.source_file = c.source_file""")
    return _with(views) + "\nUNION ALL\n".join(parts)


def _text(v) -> str:
    return "NULL" if v is None else str(v).upper() if isinstance(v, bool) else \
        str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def _oracle_sidecars() -> str:
    told = _columns_told()
    values = ",\n".join("(" + ", ".join(_text(v) for v in row.values()) + ")" for row in told)
    views = {r for _, regs in CURATED_SQL.values() for r in regs}
    return f"""{_with(views)}, cov AS ({_oracle_coverage_body()}),
told({', '.join(told[0])}) AS (VALUES {values})
SELECT told.* REPLACE (column_index::INTEGER AS column_index), cov.rows,
 coalesce(cov.first, '{profile.FIRST_START}') AS first,
 coalesce(cov.last, '{profile.LAST_START}') AS last
FROM told JOIN cov USING (table_name)"""


def _oracle_sorted_order() -> str:
    parts = [f"SELECT '{n}' AS table_name, count(*) AS rows, 0::BIGINT AS out_of_order "
             f"FROM ({sql}) t" for n, (sql, _) in CURATED_SQL.items() if TABLES[n].sorted_by]
    return _with({r for _, regs in CURATED_SQL.values() for r in regs}) + " UNION ALL ".join(parts)


def _oracle_contract_report() -> str:
    parts, views = [], set()
    for name, (sql, regs) in CURATED_SQL.items():
        views |= set(regs)
        spec = TABLES[name]
        for c in spec.columns:
            if not c.nullable:
                parts.append(f"SELECT '{name}' AS table_name, '{c.name}' AS column_name, "
                             f"'not_null' AS rule, count(*) FILTER (WHERE {c.name} IS NULL OR "
                             f"{c.name} = '') AS violations FROM ({sql}) t")
            if c.format:
                parts.append(f"SELECT '{name}', '{c.name}', 'format', count(*) FILTER (WHERE "
                             f"{c.name} <> '' AND NOT regexp_matches({c.name}, '{c.format}')) "
                             f"FROM ({sql}) t")
            if c.enum:
                vals = ", ".join(f"'{v}'" for v in c.enum)
                parts.append(f"SELECT '{name}', '{c.name}', 'enum', count(*) FILTER (WHERE "
                             f"{c.name} NOT IN ({vals})) FROM ({sql}) t")
        if "categories" in spec.extra:
            vals = ", ".join(f"'{v}'" for v in spec.extra["categories"] + ("_none",))
            parts.append(f"SELECT '{name}', 'atc_category', 'declared_category', count(*) "
                         f"FILTER (WHERE atc_category NOT IN ({vals})) FROM ({sql}) t")
    return _with(views) + "\nUNION ALL\n".join(parts)


def _oracle_pair_profile() -> str:
    parts = []
    for pair, sides in DIAGNOSIS_PAIRS.items():
        rreg, rc = sides["records"]
        dreg, dc = sides["diagnoses"]
        parts.append(f"""SELECT '{pair}' AS register,
 (SELECT count(*) FROM {rreg} WHERE {rc['record_id']} <> '' AND {rc['person_id']} <> '') AS records,
 (SELECT count(*) FROM {dreg} WHERE {dc['record_id']} <> '') AS diagnoses,
 (SELECT count(*) FROM ({DIAGNOSES_ALL_SQL}) x WHERE x.register = '{pair}') AS joined""")
    return _with(plans.diagnoses.INPUTS) + "\nUNION ALL\n".join(parts)


def _count_sql(sql: str, views, column: str) -> str:
    return _with(views) + f"SELECT {column}, count(*) AS n FROM ({sql}) t GROUP BY {column}"


ORACLE: dict[str, str] = {}
for _n in REGISTERS:
    ORACLE[f"land_{_n}"] = _with([_n]) + _land_sql(_n)
ORACLE["land_akm_sparse"] = _with(["akm"]) + _land_sql("akm", AKM_AS_SHIPPED.columns)
ORACLE["land_available_now"] = _with(["bef"]) + _landed_files_sql("bef")
ORACLE["land_files"] = _with(["ras"]) + _landed_files_sql("ras")
ORACLE["land_csv_drift"] = (
    _with(["faik"]) + ", drift AS (" + _FAIK_DRIFT_SQL.replace("{faik}", "faik") + ") "
    + _land_sql("faik").replace("source_file, ", "replace(source_file, '.sas7bdat', '.csv') "
                                "AS source_file, ", 1).replace("FROM faik", "FROM drift"))
for _t, (_sql, _regs) in CURATED_SQL.items():
    ORACLE[_t] = _with(_regs) + _sql
ORACLE.update({
    "population_unique": _with(["bef"]) + POPULATION_UNIQUE_SQL,
    "population_window": _with(["bef"]) + POPULATION_SQL,
    "diagnoses_by_register": _with(plans.diagnoses.INPUTS)
    + f"SELECT register, count(*) AS n FROM ({DIAGNOSES_ALL_SQL}) x GROUP BY register",
    "diagnoses_pair_profile": _oracle_pair_profile(),
    "income_sorted": _with(["ind"]) + INCOME_SQL,
    "prescriptions_by_category": _count_sql(PRESCRIPTIONS_SQL, ["lmdb"], "atc_category"),
    "count_by_gender": _count_sql(POPULATION_SQL, ["bef"], "gender"),
    "count_by_status_source": _count_sql(EMPLOYMENT_SQL, ["ras"], "status_source"),
    "count_by_tax_scope": _count_sql(INCOME_SQL, ["ind"], "tax_scope"),
    "count_by_patient_kind": _count_sql(DIAGNOSES_SQL, plans.diagnoses.INPUTS, "patient_kind"),
    "family_size": _with(["bef"]) + f"""SELECT family_id, count(*) AS members FROM ({POPULATION_SQL}) p
 WHERE family_id IS NOT NULL AND family_id <> '' GROUP BY family_id""",
    "prescriptions_partitioned": _with(["lmdb"]) + PRESCRIPTIONS_SQL,
    "sidecars": _oracle_sidecars(),
    "sorted_order": _oracle_sorted_order(),
    "coverage": _oracle_coverage(),
    "file_inventory": _oracle_file_inventory(),
    "rows_per_file": _oracle_rows_per_file(),
    "contract_report": _oracle_contract_report(),
})

assert set(ORACLE) <= set(QUERIES), set(ORACLE) - set(QUERIES)
