"""Sinks: landed tables, curated tables (plain, sorted, category-partitioned)
and their JSON sidecars.

* The row count and the covered period come from the write itself
  (``DataFrame.observe``): no second pass. For diagnoses the period is observed
  on the records, before the join; for population it is defined before the
  dedup, whose plan reads its input more than once, so there it is one aggregate
  over a single column.
* Writes are whole-table ``overwrite`` (an empty input still leaves a table
  with the full schema), or dynamic partition overwrite for landing, so a
  re-landed extract file replaces only itself. Spark's commit protocol makes a
  failed or retried task invisible: lost executors do not leave half files.
* Category-partitioned output is written where its rows stand, each task's rows
  sorted by category: the rows are not shuffled for it, and no task writes a
  dominant category alone. A task writes at most one file per category.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import plans
from ..operators.profile import FIRST_START, LAST_START
from ..sources.fs import read_text, write_text
from ..specs.curated import TABLES, TableSpec
from .versions import Manifest, Published, Segment

URN = "urn:column:dst:{register}:{column}"   # fixed lineage format of the sidecars


def _writer(df: DataFrame, fmt: str, mode: str, partition_by=()):
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def write_landed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Landing sink: one table per register, a folder per period and extract
    file; only the extract files present in ``df`` are replaced."""
    (_writer(df, fmt, "overwrite", ("period", "source_file"))
     .option("partitionOverwriteMode", "dynamic").save(path))


def sorted_for_write(df: DataFrame, keys) -> DataFrame:
    """Declared output order without a single-task sort: range-partition,
    then sort inside each partition; files read in partition order are
    sorted on ``keys``.

    A deterministic row hash is the last range key, so a key holding a large
    share of the rows spreads over several range partitions instead of one
    task (the order on ``keys`` is unchanged; the hash only orders ties, and
    it is the same on a retried task)."""
    keys = [F.col(k) for k in keys]
    tiebreak = F.xxhash64(*[F.col(c) for c in df.columns]).alias("_tiebreak")
    out = df.withColumn("_tiebreak", tiebreak)
    ordered = keys + [F.col("_tiebreak")]
    return out.repartitionByRange(*ordered).sortWithinPartitions(*ordered).drop("_tiebreak")


_FORMATS = {
    "parquet": {"extension": "parquet", "type": "binary"},
    "csv": {"extension": "csv", "type": "text", "delimiter": ",", "quote": "\"",
            "linebreaks": "\n"},
}


def sidecar(spec: TableSpec, rows: int, first: str | None, last: str | None,
            fmt: str) -> dict:
    """Sidecar dictionary: size, covered period, columns with lineage."""
    first = FIRST_START if first is None else first
    last = LAST_START if last is None else last
    cols = {}
    for i, c in enumerate(spec.columns):
        entry = {"index": i, "title": c.title, "description": c.description,
                 "examples": list(c.examples), "type": c.type, "nullable": c.nullable}
        if c.format:
            entry["format"] = c.format
        if c.enum:
            entry["enum"] = [{"value": v} for v in c.enum]
        if c.origin:
            entry["relations"] = [
                {"kind": "originates_from",
                 "target": URN.format(register=o.split(":")[0], column=o.split(":")[1])}
                for o in c.origin]
        cols[c.name] = entry
    return {
        "key": spec.key,
        "title": spec.title,
        "description": spec.description.format(first=first, last=last),
        "file_format": _FORMATS[fmt],
        "size": rows,
        "period": {"first": first, "last": last},
        "sorted_by": list(spec.sorted_by),
        "partitioned_by": list(spec.partition_by),
        "columns": cols,
    }


def write_curated(name: str, inputs: dict[str, DataFrame], path: str, fmt: str = "parquet",
                  sort: bool = False) -> dict:
    """Build, write and describe one curated table in one pass. Returns the
    sidecar (also written next to the table as ``<path>_metadata.json``).

    Rows are observed on the written rows; the covered period on the rows it
    is defined on -- the output itself, or, for population and diagnoses, the
    plan node before the dedup / join (``observe`` of the plan)."""
    spec = TABLES[name]
    first_col, last_col = spec.period_columns
    bounds = [F.min(first_col).alias("first"), F.max(last_col).alias("last")]
    rows_obs, bounds_obs = Observation(f"rows_{name}"), Observation(f"bounds_{name}")
    rows_metrics = [F.count(F.lit(1)).alias("rows")]
    if name == "diagnoses":
        df = plans.build(name, inputs, observe=(bounds_obs, bounds))
    else:
        df = plans.build(name, inputs)
        rows_metrics += bounds if name != "population" else []
    if sort and spec.sorted_by and not spec.partition_by:
        df = sorted_for_write(df, spec.sorted_by)
    # observed last: above any range-partition sampling job, counted once
    df = df.observe(rows_obs, *rows_metrics)
    _writer(df, fmt, "overwrite", spec.partition_by).save(path)
    got = dict(rows_obs.get)
    if name == "diagnoses":
        got |= bounds_obs.get
    elif name == "population":
        got |= plans.bounds_input(name, inputs).agg(*bounds).first().asDict()
    meta = sidecar(spec, int(got.get("rows") or 0), got.get("first"), got.get("last"), fmt)
    write_json(df.sparkSession, path.rstrip("/") + "_metadata.json", meta)
    return meta


def publish_curated(name: str, inputs: dict[str, DataFrame], root: str,
                    sort: bool = False) -> Manifest:
    """Build one curated table and publish it, with its sidecar, as the next
    version under ``root``. Readers see the old version until the new one is
    complete, and keep it if the build fails."""
    spark = next(iter(inputs.values())).sparkSession
    table = Published(spark, root)
    base, folder = table.manifest(), table.folder()
    meta = write_curated(name, inputs, f"{table.root}/{folder}", sort=sort)
    version = base.version + 1 if base else 1
    stats = {"rows": meta["size"], **meta["period"]}
    return table.publish(base, [Segment(folder, version, stats=stats)], meta)


def read_published(spark: SparkSession, name: str, root: str, version: int | None = None
                   ) -> tuple[DataFrame, dict]:
    """(rows, sidecar) of one version, the latest by default."""
    spec, table = TABLES[name], Published(spark, root)
    found = table.manifest(version)
    if found is None:
        raise FileNotFoundError(f"{root}: nothing published")
    schema = T.StructType([T.StructField(c, T.StringType())
                           for c in (*spec.names, *spec.partition_by)])
    return table.read(found.of("data"), schema), found.sidecar


def write_json(spark: SparkSession, path: str, doc: dict) -> None:
    """Write a small JSON document next to a table (any file system)."""
    write_text(spark, path, json.dumps(doc, indent=2, ensure_ascii=False))


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, path))
