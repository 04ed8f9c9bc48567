"""Landed registers bucketed by record id, for joins without a shuffle.

A landed register is written once as a catalog table with a folder per period,
and within a period bucketed and sorted by its record id. Records and diagnoses
of a pair have the same number of buckets, so each bucket of the one joins the
same bucket of the other where it is read; the period is part of the join key,
which Spark accepts on a partitioning by record id alone if asked to (a setting
of a session; the join is bound to a session of its own). Filters on the period
still prune folders.

A bucket cannot be split by the adaptive skew join. So the sizes of the bucket
files are looked at first, a listing without a job: where one bucket is much
larger than the average, a hot record id, the pair is read without its buckets
and joined by a shuffle, which can be split.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import non_empty
from ..operators.joins import normalise
from ..operators.landing import union_all
from ..plans._common import select_contract
from ..specs.curated import DIAGNOSIS_PAIRS, table
from ..sources import fs

SPEC = table("diagnoses")
#: A bucket of more than this many times the average, and of at least so many
#: bytes, is joined by a shuffle.
UNEVEN, LARGE = 4, 256 << 20

#: Estimated bytes of the largest register that a bucket is to hold, and the most
#: buckets a table may have (Spark's own limit).
SHARE, MOST = 32 << 20, 100_000

_BUCKET = re.compile(r"_([0-9]{5})\.")


def record_key(register: str) -> str:
    """The register's record id column."""
    return next(columns["record_id"] for sides in DIAGNOSIS_PAIRS.values()
                for name, columns in sides.values() if name == register)


def bucket_count(landed: Iterable[DataFrame], least: int, share: int = SHARE) -> int:
    """Buckets for registers to be joined: at least ``least``, and so many that the
    largest has about ``share`` bytes in each, by Spark's own size statistics (no
    job). What one task joins and sorts then does not grow with the registers."""
    size = max((int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
                for df in landed), default=0)
    return min(max(least, -(-size // share)), MOST)


def write_bucketed(landed: DataFrame, register: str, name: str, path: str, buckets: int) -> None:
    """Write a landed register as catalog table ``name`` at ``path``. A bucket too
    large for one task is written by several, as several files."""
    key = record_key(register)
    (landed.hint("rebalance", buckets, key).write.mode("overwrite").format("parquet")
     .option("path", path).partitionBy("period").bucketBy(buckets, key).sortBy(key)
     .saveAsTable(name))


def bucket_sizes(spark: SparkSession, path: str) -> Counter:
    """Bytes per bucket over all periods, by listing."""
    sizes: Counter = Counter()
    for folder, _ in fs.children(spark, path):
        if folder.startswith("period="):
            for file, length in fs.children(spark, f"{path}/{folder}"):
                if found := _BUCKET.search(file):
                    sizes[int(found[1])] += length
    return sizes


def even(sizes: Counter, buckets: int, large: int = LARGE) -> bool:
    """Whether no bucket holds much more than its share."""
    most = max(sizes.values(), default=0)
    return most < large or most <= UNEVEN * sum(sizes.values()) / buckets


def _session(spark: SparkSession, bucketed: bool) -> SparkSession:
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    own.conf.set("spark.sql.sources.bucketing.enabled", str(bucketed).lower())
    # else Spark reads a bucketed table unbucketed where it sees no use for it
    own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
    return own


def build(spark: SparkSession, tables: dict[str, tuple[str, str]], buckets: int,
          large: int = LARGE) -> DataFrame:
    """The diagnoses table from bucketed registers; ``tables`` gives (catalog
    table, path) by register."""
    frames = []
    for pair, sides in DIAGNOSIS_PAIRS.items():
        (rec, rec_columns), (dia, dia_columns) = sides["records"], sides["diagnoses"]
        if rec not in tables or dia not in tables:
            continue
        fits = all(even(bucket_sizes(spark, tables[r][1]), buckets, large) for r in (rec, dia))
        session = _session(spark, fits)
        records = normalise(session.table(tables[rec][0]), rec_columns, pair, F.col("period"),
                            "record_source_file") \
            .where(non_empty("record_id") & non_empty("person_id")).drop("register")
        diagnoses = normalise(session.table(tables[dia][0]), dia_columns, pair, F.col("period"),
                              "diagnosis_source_file").where(non_empty("record_id")) \
            .drop("register")
        frames.append(select_contract(records.join(diagnoses, ["period", "record_id"]), SPEC, {}))
    return union_all(frames)
