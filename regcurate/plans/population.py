"""T-7 population (register ``bef``): first file wins.

drop empty person ids -> rename -> recode gender -> keep the rows of each
person's first file (all of them; see :mod:`regcurate.operators.dedup`).
The covered period is taken *before* the dedup, over all kept-key rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import non_empty, recode_gender
from ..operators.dedup import first_file_wins, first_file_wins_window, one_row_per_key
from ..specs.curated import POPULATION_RENAMES, table
from ._common import renamed, select_contract

SPEC = table("population")
INPUTS = ("bef",)


def candidates(bef: DataFrame) -> DataFrame:
    """All person rows of all files, curated but not yet deduplicated."""
    exprs = renamed(POPULATION_RENAMES)
    exprs["gender"] = recode_gender("KOEN")
    return select_contract(bef.where(non_empty("PNR")), SPEC, exprs)


def build(bef: DataFrame) -> DataFrame:
    return first_file_wins(candidates(bef), "person_id", "source_file")


def build_window(bef: DataFrame) -> DataFrame:
    """The same table with ``rank`` over the person (small persons only)."""
    return first_file_wins_window(candidates(bef), "person_id", "source_file")


def build_unique(bef: DataFrame) -> DataFrame:
    """Exactly one row per person (the documented intent)."""
    return one_row_per_key(candidates(bef), "person_id", "source_file")


def bounds_input(bef: DataFrame) -> DataFrame:
    return candidates(bef)
