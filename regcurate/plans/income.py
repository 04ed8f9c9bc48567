"""T-6 income: one row per person and tax year (register ``ind``).

scan -> drop empty person ids -> tax year from the file name -> rename ->
contract order. Narrow transformations only: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import non_empty, year_from_file_name
from ..specs.curated import INCOME_RENAMES, table
from ._common import renamed, select_contract

SPEC = table("income")
INPUTS = ("ind",)


def build(ind: DataFrame) -> DataFrame:
    exprs = renamed(INCOME_RENAMES)
    exprs["tax_year"] = year_from_file_name(F.col("source_file"), "ind")
    return select_contract(ind.where(non_empty("PNR")), SPEC, exprs)


def bounds_input(ind: DataFrame) -> DataFrame:
    """Rows the covered period is taken from (the curated rows themselves)."""
    return build(ind)
