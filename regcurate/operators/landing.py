"""Landing operators (stage 1): keep whitelisted columns in spec order, add
provenance and the period, union the dated and undated files of a register."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import period_from_file_name
from ..specs.registers import RegisterSpec

PROVENANCE = "source_file"


def project_to_spec(df: DataFrame, columns, keep=(PROVENANCE,)) -> DataFrame:
    """Tolerant projection: spec columns in spec order; a column the input
    lacks becomes a typed null (the table keeps one fixed schema). Columns
    outside the spec are dropped. Decided at plan time from ``df.columns``."""
    present = set(df.columns)
    cols = [F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in columns]
    cols += [F.col(c) for c in keep if c in present]
    return df.select(*cols)


def land_register(df: DataFrame, spec: RegisterSpec, with_period: bool = True) -> DataFrame:
    """Rows of one register, as landed: spec columns, ``source_file`` and the
    ``period`` taken from the file name (``"0"`` for undated files)."""
    out = project_to_spec(df, spec.columns)
    if with_period:
        out = out.withColumn("period", period_from_file_name(F.col(PROVENANCE), spec.name,
                                                             spec.dated))
    return out


def union_all(frames) -> DataFrame:
    """UNION ALL by column name; columns missing on one side become null."""
    frames = list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
