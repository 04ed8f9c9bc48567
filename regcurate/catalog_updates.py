"""Queries of tables that are kept up to date: deliveries, corrections, published
versions. Each runs on landed stand-ins of the given tables, written as files or
landed tables, and has an oracle over the same views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import plans
from .catalog import (CURATED_SQL, DIAGNOSES_SQL, EDUCATION_SQL, POPULATION_CANDIDATES_SQL, POPULATION_SQL,
                      _inputs, _land_sql, _scratch, _with)
from .catalog import ORACLE as _ORACLE
from .catalog import QUERIES as _QUERIES
from .operators.landing import land_register, union_all
from .plans import incremental
from .session import fine_scans
from .sinks import bucketed
from .sinks.enforce import publish_enforced, read_rejects
from .sinks.versions import Published
from .sinks.writers import publish_curated, read_published, write_landed
from .sinks.zorder import files_read, zordered
from .sources import fs
from .sources.files import read_landed
from .sources.fixtures import register_view, stage_extracts
from .sources.footers import counts_by_partition
from .sources.ledger import land_by_ledger, read_landed_version
from .specs.curated import TABLES
from .specs.registers import REGISTERS


# --- population in deliveries -----------------------------------------------------

def _landed(spark: SparkSession, sf_dir: str, base: str, name: str) -> DataFrame:
    """A register landed as a table partitioned by period and extract."""
    spec = REGISTERS[name]
    write_landed(land_register(register_view(spark, sf_dir, name), spec), f"{base}/{name}")
    return read_landed(spark, f"{base}/{name}", spec)


def _deliveries(landed: DataFrame) -> list[set[str]]:
    """The register's extracts in three deliveries: the later half of the years,
    then every second one of the earlier half, then the rest."""
    names = sorted(r[0] for r in landed.select("source_file").distinct().collect())
    half = len(names) // 2
    return [d for d in (set(names[half:]), set(names[:half:2]), set(names[1:half:2])) if d]


def _population_by_deliveries(spark, sf_dir) -> tuple[Published, list]:
    base = _scratch(spark, "population")
    landed = _landed(spark, sf_dir, base, "bef")
    states, there = [], set()
    for files in _deliveries(landed):
        there |= files
        states.append(incremental.refresh_population(
            landed.where(F.col("source_file").isin(sorted(there))), f"{base}/published", files))
    return Published(spark, f"{base}/published"), states


def q_population_incremental(spark, sf_dir):
    """Population after three deliveries, earlier years last: persons are taken
    over from the files they came with."""
    table, states = _population_by_deliveries(spark, sf_dir)
    return incremental.live_population(table, states[-1])


def q_population_deliveries(spark, sf_dir):
    """What each delivery did: files, persons new and taken over, rows after."""
    _, states = _population_by_deliveries(spark, sf_dir)
    out = []
    for state in states:
        won = [s.stats for s in state.of("won") if s.version == state.version]
        out.append((state.version, len(state.files), sum(s["new"] for s in won),
                    sum(s["taken"] for s in won), state.sidecar["size"],
                    state.sidecar["period"]["first"], state.sidecar["period"]["last"]))
    return spark.createDataFrame(out, "version int, files int, persons_new long, "
                                      "persons_taken_over long, rows long, first string, "
                                      "last string")


_DELIVERED_SQL = f"""cands AS ({POPULATION_CANDIDATES_SQL}),
names AS (SELECT source_file, row_number() OVER (ORDER BY source_file) - 1 AS i,
  count(*) OVER () AS n FROM (SELECT DISTINCT source_file FROM bef) d),
came AS (SELECT source_file, CASE WHEN i >= n // 2 THEN 1 WHEN i % 2 = 0 THEN 2 ELSE 3 END AS v
  FROM names),
vs AS (SELECT DISTINCT v AS version FROM came),
firsts AS (SELECT version, person_id, min(source_file) AS f
  FROM cands JOIN came USING (source_file) JOIN vs ON came.v <= vs.version GROUP BY ALL),
moves AS (SELECT a.version, count(*) FILTER (WHERE b.f IS NULL) AS persons_new,
    count(*) FILTER (WHERE b.f <> a.f) AS persons_taken_over
  FROM firsts a LEFT JOIN firsts b ON b.person_id = a.person_id AND b.version = a.version - 1
  GROUP BY a.version),
held AS (SELECT f.version, count(*) AS rows FROM firsts f
  JOIN cands c ON c.person_id = f.person_id AND c.source_file = f.f GROUP BY f.version),
bounds AS (SELECT version, count(DISTINCT source_file)::INTEGER AS files, min(born_at) AS first,
    max(born_at) AS last
  FROM cands JOIN came USING (source_file) JOIN vs ON came.v <= vs.version GROUP BY version)
SELECT version, files, persons_new, persons_taken_over, rows, first, last
FROM moves JOIN held USING (version) JOIN bounds USING (version)"""


# --- diagnoses in deliveries --------------------------------------------------------

def q_diagnoses_incremental(spark, sf_dir):
    """Diagnoses after two deliveries: records of all years with the diagnoses of
    even ones, then the diagnoses of odd years; only odd years are joined again."""
    base = _scratch(spark, "diagnoses")
    landed = {n: _landed(spark, sf_dir, base, n) for n in plans.diagnoses.INPUTS}
    late = F.col("period").rlike("[13579]$")
    records = {r for r, df in landed.items() if r.endswith(("adm", "kontakter")) or
               r.startswith("patient")}
    first = {r: df if r in records else df.where(~late) for r, df in landed.items()}
    for inputs, delivered in ((first, first), (landed, {
            r: df.where(late) for r, df in landed.items() if r not in records})):
        parts = {(r, x[0]) for r, df in delivered.items()
                 for x in df.select("period").distinct().collect()}
        state = incremental.refresh_diagnoses(inputs, f"{base}/published", parts, spark)
    table = Published(spark, f"{base}/published")
    again = {s.keys["period"] for s in state.segments if s.version == state.version}
    if any(p[-1] not in "13579" for p in again):
        raise RuntimeError(f"partitions joined again without need: {sorted(again)}")
    return incremental.published_diagnoses(table, state)


# --- versions -----------------------------------------------------------------------

def q_published_versions(spark, sf_dir):
    """Education published, a rebuild that breaks half-way, and a complete one:
    what readers see after each, the table's rows beside its sidecar's."""
    root = _scratch(spark, "versions") + "/education"
    udda = register_view(spark, sf_dir, "udda")
    early = udda.where("HFAUDD < '3'")
    broken = udda.withColumn("HFAUDD", F.when(F.col("HFAUDD") < "3", F.col("HFAUDD")).otherwise(
        F.raise_error(F.lit("unreadable extract"))))
    one = dict.fromkeys(udda.columns, F.lit("1")) | {
        "HFAUDD": F.raise_error(F.lit("unreadable extract")).cast("string"),
        "source_file": F.lit("udda1900.sas7bdat")}      # breaks tables without such rows too
    broken = broken.unionByName(spark.range(1).select(*[c.alias(n) for n, c in one.items()]))
    out = []

    def seen(step: str, version: int | None = None) -> None:
        df, side = read_published(spark, "education", root, version)
        out.append(df.agg(F.count(F.lit(1)).alias("rows"), F.min("completed_at").alias("first"),
                          F.max("completed_at").alias("last")).select(
            F.lit(step).alias("step"), "rows", F.lit(side["size"]).cast("long").alias("told_rows"),
            "first", "last", F.lit(side["period"]["first"]).alias("told_first"),
            F.lit(side["period"]["last"]).alias("told_last")))

    publish_curated("education", {"udda": early}, root)
    seen("1 published")
    try:
        publish_curated("education", {"udda": broken}, root)
    except Exception as e:          # the error of the broken extract, by whatever class
        if "unreadable extract" not in str(e):
            raise
    else:
        raise RuntimeError("the broken extract was published")
    seen("2 after a broken rebuild")
    publish_curated("education", {"udda": udda}, root)
    seen("3 rebuilt")
    seen("4 pinned to the first version", 1)
    result = out[0]
    for df in out[1:]:
        result = result.unionByName(df)
    return result


def _versions_sql() -> str:
    steps = (("1 published", True), ("2 after a broken rebuild", True), ("3 rebuilt", False),
             ("4 pinned to the first version", True))
    return _with(["udda"]) + " UNION ALL ".join(
        f"SELECT '{step}' AS step, count(*) AS rows, count(*) AS told_rows, "
        "min(completed_at) AS first, max(completed_at) AS last, "
        "coalesce(min(completed_at), '9999-12-31') AS told_first, "
        "coalesce(max(completed_at), '0001-01-01') AS told_last "
        f"FROM ({EDUCATION_SQL}) t" + (" WHERE kind < '3'" if early else "")
        for step, early in steps)


# --- corrections --------------------------------------------------------------------

def _corrected(spark: SparkSession, sf_dir: str) -> tuple[str, list]:
    """bef landed by ledger from files; then the first extract is corrected (every
    second person, other gender codes), the second emptied, the third withdrawn,
    and what depends on them is brought up to date."""
    base, spec = _scratch(spark, "corrections"), REGISTERS["bef"]
    bef = register_view(spark, sf_dir, "bef")
    paths = stage_extracts(bef, spec, base)
    registers = {"bef": spec}
    run = lambda: incremental.refresh(spark, base + "/dated", None, base + "/out",
                                      registers=registers)
    first = run()
    names = [p.rsplit("/", 1)[1] for p in paths]
    stem = names[0].rsplit(".", 1)[0]
    fix = bef.where(F.col("source_file").startswith(stem)).where("right(PNR, 1) in "
                                                                 "('0', '2', '4', '6', '8')")
    fix = fix.withColumn("KOEN", F.when(F.col("KOEN") == "1", "2").otherwise("1"))
    stage_extracts(fix, spec, base + "/again")
    fs.delete(spark, paths[0])
    fs.move(spark, f"{base}/again/dated/{names[0]}", paths[0])
    empty = f"{base}/again/empty"
    bef.drop("source_file").limit(0).coalesce(1).write.parquet(empty)
    part = next(n for n, _ in fs.children(spark, empty) if n.startswith("part-"))
    fs.delete(spark, paths[1])
    fs.move(spark, f"{empty}/{part}", paths[1])
    fs.delete(spark, paths[2])
    second = run()
    if second["stage1"]["bef"] != {"added": [], "corrected": names[:1], "emptied": names[1:2],
                                   "withdrawn": names[2:3]}:
        raise RuntimeError(f"corrections not recognised: {second['stage1']}")
    if run() != {"stage1": {}, "stage2": {}}:
        raise RuntimeError("a run without changes published something")
    return base + "/out", [first, second]


def q_land_corrections(spark, sf_dir):
    """The landed register after a correction, an emptied and a withdrawn file."""
    out, _ = _corrected(spark, sf_dir)
    table = Published(spark, out + "/stage1/bef")
    return read_landed_version(table, table.manifest(), REGISTERS["bef"])


def q_population_corrected(spark, sf_dir):
    """The population after the same corrections: persons of the three extracts
    fall to the files they occur in next."""
    out, _ = _corrected(spark, sf_dir)
    return incremental.read_refreshed(spark, out, "population")[0]


_FIXED_SQL = """, ranked AS (SELECT *, dense_rank() OVER (ORDER BY source_file) AS r FROM bef),
fixed AS (SELECT * EXCLUDE (r, KOEN, source_file),
  CASE WHEN r > 3 THEN KOEN WHEN KOEN = '1' THEN '2' ELSE '1' END AS KOEN,
  replace(source_file, '.sas7bdat', '.parquet') AS source_file FROM ranked
  WHERE r > 3 OR (r = 1 AND right(PNR, 1) IN ('0', '2', '4', '6', '8'))) """


# --- counts from footers --------------------------------------------------------------

def q_landed_counts(spark, sf_dir):
    """Rows per register, period and extract of all landed registers, from the
    footers of one table partitioned by them."""
    path, parts = _scratch(spark, "landed") + "/registers", ["register", "period", "source_file"]
    # a register a job, in its own columns, written where its rows are read
    own = fine_scans(spark)
    for n, spec in REGISTERS.items():
        land_register(register_view(own, sf_dir, n), spec).write.partitionBy(*parts[1:]) \
            .parquet(f"{path}/{parts[0]}={n}")
    columns = dict.fromkeys(c for spec in REGISTERS.values() for c in spec.columns)
    schema = StructType([StructField(c, StringType()) for c in (*columns, *parts)])
    return counts_by_partition(spark, path, schema, parts)


# --- contracts enforced ---------------------------------------------------------------

def q_contract_rejects(spark, sf_dir):
    """Every curated table split into clean and rejected rows: rows per part and
    combination of broken rules, read back from what was published."""
    base, out = _scratch(spark, "rejects"), []
    for name in plans.PLANS:
        root = f"{base}/{name}"
        state = publish_enforced(name, _inputs(spark, sf_dir, name), root)
        table = Published(spark, root)
        clean, _ = read_published(spark, name, root)
        bad = read_rejects(name, table, state)
        parts = clean.select(F.lit("clean").alias("part"), F.lit("").alias("rules")).unionByName(
            bad.select(F.lit("rejects").alias("part"),
                       F.array_join("broken_rules", ",").alias("rules")))
        out.append(parts.groupBy("part", "rules").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "part", "rules", "rows"))
    return union_all(out)


def _rejects_sql() -> str:
    parts, views = [], set()
    for name, (sql, regs) in CURATED_SQL.items():
        views |= set(regs)
        spec, rules = TABLES[name], []
        for c in spec.columns:
            if not c.nullable:
                rules.append((c.name, "not_null", f"{c.name} IS NULL OR {c.name} = ''"))
            if c.format:
                rules.append((c.name, "format", f"{c.name} <> '' AND NOT "
                              f"regexp_matches({c.name}, '{c.format}')"))
            if c.enum:
                values = ", ".join(f"'{v}'" for v in c.enum)
                rules.append((c.name, "enum", f"{c.name} NOT IN ({values})"))
        if "categories" in spec.extra:
            values = ", ".join(f"'{v}'" for v in spec.extra["categories"] + ("_none",))
            rules.append(("atc_category", "declared_category", f"atc_category NOT IN ({values})"))
        told = ", ".join(f"CASE WHEN {w} THEN '{c}:{r}' END" for c, r, w in rules) or "NULL"
        parts.append(f"SELECT '{name}' AS table_name, CASE WHEN rules = '' THEN 'clean' ELSE "
                     f"'rejects' END AS part, rules, count(*) AS rows FROM "
                     f"(SELECT concat_ws(',', {told}) AS rules FROM ({sql}) t) x GROUP BY rules")
    return _with(views) + "\nUNION ALL\n".join(parts)


# --- file layouts of the diagnoses -------------------------------------------------------

_FILES, _FILE_BYTES = 16, 32 << 20      # files at least, and bytes a file at most, about


def q_diagnoses_bucketed(spark, sf_dir):
    """Diagnoses from landed registers bucketed by record id: no shuffle below the
    joins."""
    base, tables = _scratch(spark, "bucketed"), {}
    mark = base.rsplit("-", 1)[1]
    landed = {r: land_register(register_view(spark, sf_dir, r), REGISTERS[r])
              for r in plans.diagnoses.INPUTS}
    buckets = bucketed.bucket_count(landed.values(), _FILES)
    for register, rows in landed.items():
        tables[register] = (f"bucketed_{mark}_{register}", f"{base}/{register}")
        bucketed.write_bucketed(rows, register, *tables[register], buckets)
    return bucketed.build(spark, tables, buckets)


def q_zorder_files(spark, sf_dir):
    """The diagnoses' files clustered on both declared keys against the plain
    order: whether a filter on a key reads fewer than half the files."""
    base, keys = _scratch(spark, "zorder"), list(TABLES["diagnoses"].sorted_by)
    plans.build("diagnoses", _inputs(spark, sf_dir, "diagnoses")).write.parquet(f"{base}/table")
    table = spark.read.parquet(f"{base}/table")
    files = max(_FILES, -(-fs.size(spark, f"{base}/table") // _FILE_BYTES))
    layouts = {"zorder": zordered(table, keys, files),
               "plain": table.repartitionByRange(files, *keys).sortWithinPartitions(*keys)}
    out = []
    for name, df in layouts.items():
        df.write.parquet(f"{base}/{name}")
        found = files_read(spark.read.parquet(f"{base}/{name}"), keys)
        out.append(found.select(F.lit(name).alias("layout"), "key", "n_values", (
            F.col("files_read") < F.col("files") / 2).alias("under_half")))
    return union_all(out)


QUERIES = {
    **_QUERIES,
    "diagnoses_bucketed": q_diagnoses_bucketed,
    "zorder_files": q_zorder_files,
    "landed_counts": q_landed_counts,
    "contract_rejects": q_contract_rejects,
    "population_incremental": q_population_incremental,
    "population_deliveries": q_population_deliveries,
    "diagnoses_incremental": q_diagnoses_incremental,
    "published_versions": q_published_versions,
    "land_corrections": q_land_corrections,
    "population_corrected": q_population_corrected,
}

ORACLE = {
    **_ORACLE,
    "diagnoses_bucketed": _with(plans.diagnoses.INPUTS) + DIAGNOSES_SQL,
    "zorder_files": _with(plans.diagnoses.INPUTS) + " UNION ALL ".join(
        f"SELECT '{layout}' AS layout, '{key}' AS key, count(DISTINCT {key}) AS n_values, "
        f"{half} AS under_half FROM ({DIAGNOSES_SQL}) d"
        for layout, key, half in (("zorder", "person_id", "true"), ("zorder", "record_id", "true"),
                                  ("plain", "person_id", "true"),
                                  ("plain", "record_id", "false"))),
    "landed_counts": _with(REGISTERS) + "\nUNION ALL\n".join(
        f"SELECT '{n}' AS register, period, source_file, count(*) AS rows "
        f"FROM ({_land_sql(n)}) l GROUP BY ALL" for n in REGISTERS),
    "contract_rejects": _rejects_sql(),
    "population_incremental": _with(["bef"]) + POPULATION_SQL,
    "population_deliveries": _with(["bef"]).rstrip() + ", " + _DELIVERED_SQL,
    "diagnoses_incremental": _with(plans.diagnoses.INPUTS) + DIAGNOSES_SQL,
    "published_versions": _versions_sql(),
    "land_corrections": _with(["bef"]).rstrip() + _FIXED_SQL
    + _land_sql("bef").replace("FROM bef", "FROM fixed"),
    "population_corrected": _with(["bef"]).rstrip() + _FIXED_SQL
    + POPULATION_SQL.replace("FROM bef", "FROM fixed"),
}
