"""T-5 family income: one row per family and tax year (register ``faik``).

Same shape as income, keyed by family. Narrow: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import non_empty, year_from_file_name
from ..specs.curated import FAMILY_INCOME_RENAMES, table
from ._common import renamed, select_contract

SPEC = table("family_income")
INPUTS = ("faik",)


def build(faik: DataFrame) -> DataFrame:
    exprs = renamed(FAMILY_INCOME_RENAMES)
    exprs["tax_year"] = year_from_file_name(F.col("source_file"), "faik")
    return select_contract(faik.where(non_empty("FAMILIE_ID")), SPEC, exprs)


def bounds_input(faik: DataFrame) -> DataFrame:
    return build(faik)
