"""T-3 education (register ``udda``): rename, drop empty person ids; the raw
``UDD`` column is not carried. Narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import non_empty
from ..specs.curated import EDUCATION_RENAMES, table
from ._common import renamed, select_contract

SPEC = table("education")
INPUTS = ("udda",)


def build(udda: DataFrame) -> DataFrame:
    return select_contract(udda.where(non_empty("PNR")), SPEC, renamed(EDUCATION_RENAMES))


def bounds_input(udda: DataFrame) -> DataFrame:
    return build(udda)
