"""T-8 prescriptions (register ``lmdb``): raw columns renamed by position,
plus the ATC category (first letter; missing code -> ``_none``) used to
partition the output. No key filter. Narrow: no shuffle until the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import atc_category
from ..specs.curated import PRESCRIPTION_COLUMNS, table
from ..specs.registers import spec as register_spec

SPEC = table("prescriptions")
INPUTS = ("lmdb",)


def build(lmdb: DataFrame) -> DataFrame:
    raw = register_spec("lmdb").columns
    df = lmdb.select(*[F.col(r).alias(n) for r, n in zip(raw, PRESCRIPTION_COLUMNS)],
                     F.col("source_file"))
    return df.withColumn("atc_category", atc_category("atc_id"))


def bounds_input(lmdb: DataFrame) -> DataFrame:
    return build(lmdb)
