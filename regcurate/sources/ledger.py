"""Landing by ledger: corrected, emptied and withdrawn extracts.

The landed table of a register is published in versions
(:mod:`regcurate.sinks.versions`); its manifest is the ledger: per extract file
its length, modification time, SHA-256 and the rows it gave. A run compares the
folders with the ledger:

* a file the ledger lacks is *added*;
* one whose length or time differs is read through once more; if its digest
  differs too it is *corrected*, or *emptied* if it has no rows left;
* one that is no longer there is *withdrawn*.

Added and corrected files are read and landed, the partitions of corrected,
emptied and withdrawn ones drop out, and the new state is published at once:
readers see a delivery as a whole or not at all. A file that only got a new time
is noted, not landed. A rerun without changes publishes nothing.

The driver handles one ledger line per file, as Spark's own file index does;
digests are taken on the executors, in chunks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import base_name, dataset_from_file_name, period_from_file_name
from ..operators.landing import PROVENANCE
from ..session import ship_package
from ..sinks.versions import Manifest, Published, with_stats
from ..specs.registers import RegisterSpec
from .files import landed_schema, read_files
from .fs import exists, resolve

_PARTS = ("period", PROVENANCE)
_EXTRACT = "extract"


@dataclass(frozen=True)
class Delivery:
    """What a run found. ``added`` and ``changed`` are source file names, the
    other lists names of extract files; ``periods`` those of all of them."""

    added: frozenset = frozenset()
    changed: frozenset = frozenset()
    periods: frozenset = frozenset()
    kinds: dict = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.added or self.changed)


def listed(spark: SparkSession, folder: str | None, spec: RegisterSpec, dated: bool,
           fmt: str) -> dict[str, tuple[str, int, int]]:
    """name -> (path, length, modified) of a register's files in a folder."""
    if not folder or not exists(spark, folder):
        return {}
    glob = f"{spec.name}*.{fmt}" if dated else f"{spec.name}.{fmt}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder) \
        .select("path", base_name("path").alias("name"), "length",
                F.unix_millis("modificationTime").alias("modified")) \
        .where(dataset_from_file_name("name", dated) == F.lit(spec.name))
    return {r["name"]: (r["path"], r["length"], r["modified"]) for r in files.collect()}


def digests(spark: SparkSession, paths: list[str], chunk: int = 1 << 20) -> dict[str, str]:
    """SHA-256 of each file, taken on the executors a chunk at a time."""
    if not paths:
        return {}
    ship_package(spark)

    def run(batches):
        import hashlib

        import pandas as pd

        for pdf in batches:
            out = []
            for path in pdf["path"]:
                filesystem, p = resolve(path)
                sha = hashlib.sha256()
                with filesystem.open_input_stream(p) as stream:
                    while data := stream.read(chunk):
                        sha.update(data)
                out.append(sha.hexdigest())
            yield pd.DataFrame({"path": pdf["path"], "digest": out})

    files = spark.createDataFrame([(p,) for p in paths], "path string") \
        .repartition(max(1, min(len(paths), 1000)), "path")
    return {r["path"]: r["digest"]
            for r in files.mapInPandas(run, "path string, digest string").collect()}


def _schema(spec: RegisterSpec) -> T.StructType:
    columns = [f for f in landed_schema(spec).fields if f.name not in _PARTS]
    return T.StructType([*columns, T.StructField(_EXTRACT, T.StringType()),
                         *[T.StructField(p, T.StringType()) for p in _PARTS]])


def read_landed_version(table: Published, found: Manifest, spec: RegisterSpec) -> DataFrame:
    """The landed rows of a version: spec columns, ``source_file``, ``period``,
    the last two from the folders, so that filters on them prune."""
    return table.read(found.of("data"), _schema(spec)).select(landed_schema(spec).names)


def land_by_ledger(spark: SparkSession, dated_dir: str | None, undated_dir: str | None,
                   spec: RegisterSpec, root: str, fmt: str = "parquet"
                   ) -> tuple[Manifest | None, Delivery]:
    """Bring the landed table of one register up to date with its folders."""
    table = Published(spark, root)
    base = table.manifest()
    ledger = dict(base.files) if base else {}
    there = listed(spark, undated_dir, spec, False, fmt)
    if spec.dated:
        there |= listed(spark, dated_dir, spec, True, fmt)
    suspects = {n for n, (_, length, modified) in there.items() if n not in ledger
                or (ledger[n]["length"], ledger[n]["modified"]) != (length, modified)}
    found = digests(spark, [there[n][0] for n in sorted(suspects)])
    digest = {n: found[there[n][0]] for n in suspects}
    added = {n for n in suspects if n not in ledger}
    differs = {n for n in suspects - added if ledger[n]["digest"] != digest[n]}
    withdrawn = {*ledger} - {*there}
    if not suspects and not withdrawn:
        return base, Delivery()
    version = base.version + 1 if base else 1
    replaced = {s for n in differs | withdrawn for s in ledger[n]["sources"]}
    kept = [s for s in (base.segments if base else ()) if s.keys[PROVENANCE] not in replaced]
    new, given = [], {}
    if added | differs:
        files = spark.createDataFrame([(there[n][0],) for n in sorted(added | differs)],
                                      "path string")
        rows = read_files(spark, files, spec, fmt, extract=_EXTRACT)
        period = period_from_file_name(F.col(PROVENANCE), spec.name, spec.dated)
        landed = rows.withColumn("period", period)
        new = table.write(landed.hint("rebalance", *_PARTS), version, partition_by=_PARTS)
        counts = table.read(new, _schema(spec)).groupBy(_EXTRACT, *_PARTS).count().collect()
        for r in counts:
            given.setdefault(r[_EXTRACT], {})[r[PROVENANCE]] = r["count"]
        per_part: dict[tuple, dict] = {}
        for r in counts:
            stats = per_part.setdefault(tuple(r[p] for p in _PARTS), {"rows": 0})
            stats["rows"] += r["count"]
        new = with_stats(new, per_part, _PARTS)
    files = {n: line for n, line in ledger.items() if n not in withdrawn}
    for n in suspects:
        _, length, modified = there[n]
        sources = given.get(n, {}) if n in added | differs else ledger[n]["sources"]
        files[n] = {"length": length, "modified": modified, "digest": digest[n],
                    "sources": sources}
    emptied = {n for n in differs if not given.get(n)}
    size = sum(sum(line["sources"].values()) for line in files.values())
    done = table.publish(base, [*kept, *new], {"key": spec.name, "size": size}, files)
    fresh = {s for n in added for s in given.get(n, {})}
    changed = replaced | {s for n in differs for s in given.get(n, {})}
    periods = {s.keys["period"] for s in (base.segments if base else ())
               if s.keys[PROVENANCE] in replaced} | {s.keys["period"] for s in new}
    kinds = {"added": sorted(added), "corrected": sorted(differs - emptied),
             "emptied": sorted(emptied), "withdrawn": sorted(withdrawn)}
    return done, Delivery(frozenset(fresh - changed), frozenset(changed), frozenset(periods),
                          kinds)

