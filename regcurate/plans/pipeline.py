"""The whole run: land every register, then build every curated table.

    land(spark, dated_dir, undated_dir, out)
        -> out/stage1/<register>/period=<p>/source_file=<f>/...
    curate(spark, out, landed)
        -> out/stage2/<table>[ + _metadata.json]

Stage 1 writes one table per register (a written table cuts the lineage;
stage 2 reads it back with partition pruning). The loops run over registers and
tables -- metadata -- never over rows.
"""

from __future__ import annotations

import os
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.landing import land_register, union_all
from ..session import sized_shuffles
from ..sinks.writers import write_curated, write_landed
from ..sources.files import files_without_key, folder_files, read_files, read_landed
from ..sources.fs import exists
from ..specs.registers import KEY_COLUMNS, REGISTERS, RegisterSpec
from ..streaming.landing import land_available_now
from . import MULTI_INPUT, PLANS, accepts, diagnoses


class MissingKeyColumn(ValueError):
    """Landed files lack a column their curated table filters by."""


def land(spark: SparkSession, dated_dir: str | None, undated_dir: str | None, out: str,
         fmt: str = "parquet", registers: dict[str, RegisterSpec] | None = None,
         incremental: bool = False) -> dict:
    """Land every register that has files; returns ``{register: path}``.

    ``incremental=True`` lands only files not landed before (a file-stream
    checkpoint per register under ``out/_checkpoints``); a rerun with no new
    file adds nothing. Both modes write the same layout, so they may be mixed."""
    registers = REGISTERS if registers is None else registers
    folders = {dated: folder_files(spark, d, dated, registers, f"*.{fmt}")
               for dated, d in ((True, dated_dir), (False, undated_dir))}
    # one row per register and folder: bounded by the spec
    present = {dated: set() if files is None else
               {r["dataset"] for r in files.select("dataset").distinct().collect()}
               for dated, files in folders.items()}
    done = {}
    for name, spec in registers.items():
        path = os.path.join(out, "stage1", name)
        sides = [dated for dated in (True, False)
                 if name in present[dated] and (spec.dated or not dated)]
        if sides and incremental:
            land_available_now(spark, dated_dir if True in sides else None,
                               undated_dir if False in sides else None, spec, path,
                               os.path.join(out, "_checkpoints", "stage1", name), fmt)
        elif sides:
            files = union_all(folders[d].where(F.col("dataset") == name).select("path")
                              for d in sides)
            write_landed(land_register(read_files(spark, files, spec, fmt), spec), path)
        if exists(spark, path):
            done[name] = path
    return done


def landed_inputs(spark: SparkSession, out: str, names,
                  registers: dict[str, RegisterSpec] | None = None) -> dict[str, DataFrame]:
    """The landed tables of ``names`` under ``out/stage1``."""
    registers = REGISTERS if registers is None else registers
    return {n: read_landed(spark, os.path.join(out, "stage1", n), registers[n]) for n in names}


def missing_inputs(landed) -> dict[str, list[str]]:
    """Per curated table the input registers that were not landed: the table is
    left out or, for the tables of several registers, lacks their rows."""
    gaps = {}
    for name, mod in PLANS.items():
        gone = [r for r in mod.INPUTS if r not in landed]
        if name == "deaths" and len(gone) < len(mod.INPUTS):
            continue                    # any one of its registers will do
        if gone:
            gaps[name] = gone
    return gaps


def check_keys(inputs: dict[str, DataFrame]) -> None:
    """Raise if a file has rows but no value in a key column: the key filter
    would drop the whole file without a word."""
    found = [files_without_key(df, KEY_COLUMNS[n]).select(F.lit(n).alias("register"), "*")
             for n, df in inputs.items() if n in KEY_COLUMNS]
    gone = union_all(found).limit(20).collect() if found else []
    if gone:
        raise MissingKeyColumn("; ".join(f"{r['source_file']} has no {r['key']}" for r in gone))


def curate(spark: SparkSession, out: str, landed: dict[str, str], fmt: str = "parquet",
           sort: bool = False, registers: dict[str, RegisterSpec] | None = None,
           strict_keys: bool = True) -> dict:
    """Build every curated table whose inputs were landed; returns sidecars.
    Missing inputs are warned about (see :func:`missing_inputs`); a file without
    a key column is an error unless ``strict_keys`` is off."""
    registers = REGISTERS if registers is None else registers
    inputs = {n: read_landed(spark, p, registers[n]) for n, p in landed.items()}
    for name, gone in missing_inputs(landed).items():
        warnings.warn(f"{name}: no landed files of {', '.join(gone)}", stacklevel=2)
    if strict_keys:
        check_keys(inputs)
    sidecars = {}
    for name, mod in PLANS.items():
        own = {r: df for r, df in inputs.items() if accepts(name, r)}
        if not own or (name not in MULTI_INPUT and len(own) < len(mod.INPUTS)):
            continue
        if name == "diagnoses" and len(diagnoses.missing_pairs(own)) == len(
                diagnoses.DIAGNOSIS_PAIRS):
            continue
        with sized_shuffles(spark, own.values()):
            sidecars[name] = write_curated(name, own, os.path.join(out, "stage2", name), fmt, sort)
    return sidecars


def run(spark: SparkSession, dated_dir: str | None, undated_dir: str | None, out: str,
        fmt: str = "parquet", output_fmt: str = "parquet",
        registers: dict[str, RegisterSpec] | None = None, incremental: bool = False,
        sort: bool = False) -> dict:
    landed = land(spark, dated_dir, undated_dir, out, fmt, registers, incremental)
    return {"stage1": landed, "missing": missing_inputs(landed),
            "stage2": curate(spark, out, landed, output_fmt, sort, registers)}
