"""Counts of landed tables from Parquet footers.

The DataSource V2 Parquet scan answers ``count(*)`` grouped by partition columns
from the row counts in the file footers: no column chunk is read, one row per
file leaves the scan. The file source reads Parquet through V1 unless told
otherwise, and the setting belongs to a session; so the scan is bound to a
session of its own beside the caller's, whose settings stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.landing import PROVENANCE
from ..specs.registers import RegisterSpec
from .files import landed_schema

_SETTINGS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
             "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session in which Parquet aggregates are pushed to the scan."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    for key, value in _SETTINGS.items():
        own.conf.set(key, value)
    return own


def counts_by_partition(spark: SparkSession, path: str, schema: T.StructType,
                        keys: Sequence[str]) -> DataFrame:
    """``keys`` (partition columns) and ``rows``; partitions without a file are
    absent, those whose files are empty have 0 rows."""
    table = footer_session(spark).read.schema(schema).parquet(path)
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def landed_counts(spark: SparkSession, path: str, spec: RegisterSpec) -> DataFrame:
    """Rows per period and extract of a landed register."""
    return counts_by_partition(spark, path, landed_schema(spec), ("period", PROVENANCE))
