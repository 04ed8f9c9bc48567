"""Curated tables kept up to date with landed extract files.

A delivery names files: ``added`` (not seen before) and ``changed`` (corrected,
emptied or withdrawn). Only what depends on them is computed, and published as
the next version (:mod:`regcurate.sinks.versions`):

* **population** (:func:`refresh_population`). A person belongs to the first file
  they occur in. An added file that sorts before a person's file takes the person
  over; otherwise only unseen persons come in. Segments are never rewritten: a
  ``won`` segment lists the persons each version placed (with the file they were
  taken from), and a row counts if no later version took its person over. After a
  change the persons of that file, old and new, are placed anew from all landed
  files.
* **diagnoses** (:func:`refresh_diagnoses`). A file touches one (pair, period);
  those partitions are joined again, from landed partitions pruned to them, and
  replace the old ones.
* **the tables that only filter** (:func:`refresh_narrow`). A row depends on its
  own file alone: partitions per file are added, replaced or dropped.

Row counts and covered periods are kept per segment and per file, so a sidecar is
a fold over the manifest, never another pass over the table.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.landing import PROVENANCE
from ..sinks.versions import Manifest, Published, Segment, with_stats
from ..sinks.writers import sidecar
from ..sources.ledger import land_by_ledger, read_landed_version
from ..specs.curated import DIAGNOSIS_PAIRS, TABLES
from ..specs.registers import REGISTERS, RegisterSpec
from . import PLANS, accepts, build, diagnoses, population

NARROW = tuple(n for n in PLANS if n not in ("population", "diagnoses"))


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _least(values) -> str | None:
    return min((v for v in values if v is not None), default=None)


def _greatest(values) -> str | None:
    return max((v for v in values if v is not None), default=None)


def _describe(name: str, rows: int, stats: Iterable[dict]) -> dict:
    stats = list(stats)
    return sidecar(TABLES[name], rows, _least(s.get("first") for s in stats),
                   _greatest(s.get("last") for s in stats), "parquet")


def _named(files: Iterable[str], column: str = PROVENANCE) -> F.Column:
    files = sorted(files)
    return F.col(column).isin(files) if files else F.lit(False)


# --- population -----------------------------------------------------------------

_WON = T.StructType([T.StructField("person_id", T.StringType()),
                     T.StructField("now", T.StringType()), T.StructField("before", T.StringType()),
                     T.StructField("rows", T.LongType())])


def live_population(table: Published, found: Manifest, columns: Iterable[str] = ()) -> DataFrame:
    """The rows of a version: those of each segment whose person no later version
    took over. Take-overs are few against the rows, one row per person and
    version; Spark broadcasts or shuffles them by their size."""
    columns = list(columns) or population.SPEC.names
    rows = table.read(found.of("data"), _strings(*population.SPEC.names), at="_at")
    taken = [s for s in found.of("won") if s.stats.get("taken")]
    if not taken:
        return rows.select(columns)
    gone = table.read(taken, _WON, at="_at").where("before is not null").groupBy(
        F.col("person_id").alias("_person")).agg(F.max("_at").alias("_gone"))
    return rows.join(gone, F.col("person_id") == F.col("_person"), "left") \
        .where("_gone is null or _at >= _gone").select(columns)


def _file_stats(candidates: DataFrame, first: str, last: str) -> dict[str, dict]:
    """Per extract file its rows with a person and their bounds: one row per
    file."""
    rows = candidates.groupBy(PROVENANCE).agg(
        F.count(F.lit(1)).alias("rows"), F.min(first).alias("first"),
        F.max(last).alias("last")).collect()
    return {r[PROVENANCE]: {"rows": r["rows"], "first": r["first"], "last": r["last"]}
            for r in rows}


def refresh_population(landed: DataFrame, root: str, added: Iterable[str],
                       changed: Iterable[str] = ()) -> Manifest:
    """Publish the population after a delivery. ``landed``: the landed register as
    it is now; ``added``, ``changed``: names of the delivery's files."""
    table = Published(landed.sparkSession, root)
    base = table.manifest()
    known = dict(base.files) if base else {}
    changed = {*changed}
    added, changed = {*added} | (changed - {*known}), changed & {*known}
    # a file without persons has placed nobody: it may come as a new one
    added = {f for f in added if f in changed or not known.get(f, {}).get("rows")}
    if base is not None and not added and not changed:
        return base
    version = base.version + 1 if base else 1
    live = live_population(table, base, ["person_id", PROVENANCE]) if base else \
        landed.sparkSession.createDataFrame([], _strings("person_id", PROVENANCE))
    owners = live.groupBy("person_id").agg(F.min(PROVENANCE).alias("before"),
                                           F.count(F.lit(1)).alias("rows"))
    new = population.candidates(landed.where(_named(added | changed)))
    if changed:
        # persons of a changed file, as it was and as it is, are placed anew
        moved = live.where(_named(changed)).select("person_id").union(
            new.select("person_id")).distinct()
        pool = population.candidates(landed).join(moved, "person_id", "left_semi")
        first = pool.groupBy("person_id").agg(F.min(PROVENANCE).alias("now"))
        placed = moved.join(first, "person_id", "left").join(owners, "person_id", "left")
        stays = ~_named(changed, "before") & F.col("before").eqNullSafe(F.col("now"))
        placed = placed.where(~F.coalesce(stays, F.lit(False)))
    else:
        pool = new
        first = pool.groupBy("person_id").agg(F.min(PROVENANCE).alias("now"))
        placed = first.join(owners, "person_id", "left") \
            .where("before is null or now < before")
    won = table.write(placed.selectExpr("person_id", "now", "before",
                                        "coalesce(rows, 0L) as rows"), version, "won")
    placed = table.read(won, _WON)
    lost = placed.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                      F.count("before").alias("taken"),
                      F.count_if(F.expr("before is null and now is not null")).alias("new")
                      ).first().asDict()
    seen = Observation()
    to = placed.select(F.col("person_id").alias("_person"), F.col("now").alias("_now"))
    rows = pool.join(to, (F.col("person_id") == F.col("_person"))
                     & (F.col(PROVENANCE) == F.col("_now"))).select(population.SPEC.names)
    data = table.write(rows.observe(seen, F.count(F.lit(1)).alias("rows")), version)
    came = int(seen.get.get("rows") or 0)
    files = {f: s for f, s in known.items() if f not in changed}
    fresh = _file_stats(new, *population.SPEC.period_columns)
    files |= {f: fresh.get(f, {"rows": 0}) for f in added | changed}
    total = (base.sidecar["size"] if base else 0) - int(lost["rows"]) + came
    segments = [*(base.segments if base else ()),
                *with_stats(won, {(): {"taken": int(lost["taken"]), "new": int(lost["new"])}}, ()),
                *with_stats(data, {(): {"rows": came}}, ())]
    return table.publish(base, segments, _describe("population", total, files.values()), files)


def compact_population(table: Published) -> Manifest:
    """One segment of the live rows in place of all segments."""
    base = table.manifest()
    version = base.version + 1
    data = table.write(live_population(table, base), version)
    return table.publish(base, with_stats(data, {(): {"rows": base.sidecar["size"]}}, ()),
                         base.sidecar, base.files)


# --- diagnoses ------------------------------------------------------------------

_PART = ("register", "period")


def touched(parts: Iterable[tuple[str, str]]) -> set[tuple[str, str]]:
    """(pair, period) partitions that depend on landed (register, period) parts."""
    sides = {pair: {side[0] for side in both.values()} for pair, both in DIAGNOSIS_PAIRS.items()}
    return {(pair, period) for register, period in parts
            for pair, registers in sides.items() if register in registers}


def pruned(landed: dict[str, DataFrame], parts: set[tuple[str, str]]) -> dict[str, DataFrame]:
    """The landed registers, each cut down to the periods of the partitions it is
    a side of: a filter on the partition column, so other folders are not read."""
    periods: dict[str, set[str]] = {}
    for pair, period in parts:
        for register, _ in DIAGNOSIS_PAIRS[pair].values():
            periods.setdefault(register, set()).add(period)
    return {r: landed[r].where(_named(p, "period")) for r, p in periods.items() if r in landed}


def refresh_diagnoses(landed: dict[str, DataFrame], root: str,
                      parts: Iterable[tuple[str, str]], spark: SparkSession) -> Manifest:
    """Publish the diagnoses after the landed (register, period) ``parts`` have
    changed: those partitions are rebuilt, all others stay as they are."""
    spec, table = TABLES["diagnoses"], Published(spark, root)
    base, parts = table.manifest(), touched(parts)
    version = base.version + 1 if base else 1
    kept = [s for s in (base.segments if base else ())
            if (s.keys["register"], s.keys["period"]) not in parts]
    bounds = {k: s for k, s in (base.files if base else {}).items()
              if tuple(k.split("/")) not in parts}
    inputs = pruned(landed, parts)
    new: list[Segment] = []
    if parts and len(diagnoses.missing_pairs(inputs)) < len(DIAGNOSIS_PAIRS):
        # the join's tasks write their own rows, which a merge join leaves in this order
        new = table.write(diagnoses.build_by_part(inputs), version, partition_by=_PART)
        counts = {tuple(r[:2]): {"rows": r[2]} for r in table.read(
            new, _strings(*spec.names, *_PART)).groupBy(*_PART).count().collect()}
        new = with_stats(new, counts, _PART)
    if inputs and any(DIAGNOSIS_PAIRS[p]["records"][0] in inputs for p, _ in parts):
        first, last = spec.period_columns           # on the records, before the join
        for r in diagnoses.records(inputs).groupBy(*_PART).agg(
                F.min(first).alias("first"), F.max(last).alias("last")).collect():
            if (r["register"], r["period"]) in parts:
                bounds[f"{r['register']}/{r['period']}"] = {"first": r["first"], "last": r["last"]}
    segments = kept + new
    meta = _describe("diagnoses", sum(s.stats.get("rows", 0) for s in segments), bounds.values())
    return table.publish(base, segments, meta, bounds)


def published_diagnoses(table: Published, found: Manifest) -> DataFrame:
    names = TABLES["diagnoses"].names
    return table.read(found.of("data"), _strings(*names, *_PART)).select(names)


# --- tables that only filter ------------------------------------------------------

_FILE = "from_file"


def refresh_narrow(name: str, landed: dict[str, DataFrame], root: str, added: Iterable[str],
                   changed: Iterable[str], spark: SparkSession) -> Manifest:
    """Publish a table whose rows depend on their own extract file only."""
    spec, table = TABLES[name], Published(spark, root)
    base = table.manifest()
    version = base.version + 1 if base else 1
    files = {*added, *changed}
    kept = [s for s in (base.segments if base else ()) if s.keys[_FILE] not in files]
    rows = build(name, {r: df.where(_named(files)) for r, df in landed.items()}) \
        .withColumn(_FILE, F.col(PROVENANCE)).hint("rebalance", _FILE)
    new = table.write(rows, version, partition_by=(_FILE,))
    first, last = spec.period_columns
    schema = _strings(*spec.names, *spec.partition_by, _FILE)
    stats = {(r[0],): {"rows": r[1], "first": r[2], "last": r[3]} for r in table.read(
        new, schema).groupBy(_FILE).agg(F.count(F.lit(1)), F.min(first), F.max(last)).collect()}
    segments = kept + with_stats(new, stats, (_FILE,))
    meta = _describe(name, sum(s.stats.get("rows", 0) for s in segments),
                     [s.stats for s in segments])
    return table.publish(base, segments, meta)


def published_narrow(name: str, table: Published, found: Manifest) -> DataFrame:
    spec = TABLES[name]
    columns = [*spec.names, *spec.partition_by]
    return table.read(found.of("data"), _strings(*columns, _FILE)).select(columns)


# --- everything -------------------------------------------------------------------

def reader(name: str) -> Callable[[Published, Manifest], DataFrame]:
    """How a table kept up to date is read."""
    if name == "population":
        return live_population
    if name == "diagnoses":
        return published_diagnoses
    return lambda table, found: published_narrow(name, table, found)


def read_refreshed(spark: SparkSession, out: str, name: str, version: int | None = None
                   ) -> tuple[DataFrame, dict]:
    """(rows, sidecar) of a version of a table that :func:`refresh` keeps."""
    table = Published(spark, os.path.join(out, "stage2", name))
    found = table.manifest(version)
    if found is None:
        raise FileNotFoundError(f"{table.root}: nothing published")
    return reader(name)(table, found), found.sidecar


def refresh(spark: SparkSession, dated_dir: str | None, undated_dir: str | None, out: str,
            fmt: str = "parquet", registers: dict[str, RegisterSpec] | None = None) -> dict:
    """Land what was added, corrected, emptied or withdrawn since the last run, and
    publish the curated tables that depend on it. Returns, per register, what was
    found, and, per table published, its version and rows."""
    registers = REGISTERS if registers is None else registers
    landed, found = {}, {}
    for name, spec in registers.items():
        table = Published(spark, os.path.join(out, "stage1", name))
        state, delivery = land_by_ledger(spark, dated_dir, undated_dir, spec, table.root, fmt)
        if state is not None:
            landed[name] = read_landed_version(table, state, spec)
        if delivery:
            found[name] = delivery
    done = {}
    for name, plan in PLANS.items():
        regs = [r for r in registers if accepts(name, r) and r in found]
        if not regs:
            continue
        root = os.path.join(out, "stage2", name)
        own = {r: df for r, df in landed.items() if accepts(name, r)}
        added = {f for r in regs for f in found[r].added}
        changed = {f for r in regs for f in found[r].changed}
        if name == "population":
            state = refresh_population(landed[plan.INPUTS[0]], root, added, changed)
        elif name == "diagnoses":
            parts = {(r, p) for r in regs for p in found[r].periods}
            state = refresh_diagnoses(own, root, parts, spark)
        else:
            state = refresh_narrow(name, own, root, added, changed, spark)
        done[name] = {"version": state.version, "rows": state.sidecar["size"]}
    return {"stage1": {r: d.kinds for r, d in found.items()}, "stage2": done}
