"""T-1 deaths: every ``dodsaa*`` register, in two variants with different
column names, renamed by position onto one contract.

The variant is picked per row from the file name (case-folded prefix
``dodsaars``, else the other), as files may be mixed in one input. No key filter (the
source applies none here). Narrow: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.landing import project_to_spec, union_all
from ..specs.curated import (DEATHS_COLUMNS, DEATHS_PRIMARY_PREFIX, DEATHS_REGISTER_PREFIX,
                             DEATHS_VARIANTS, table)
from ._common import select_contract

SPEC = table("deaths")
INPUTS = tuple(DEATHS_VARIANTS)


def accepts(register: str) -> bool:
    """Whether a register is an input of this table."""
    return register.startswith(DEATHS_REGISTER_PREFIX)


def build(inputs: dict[str, DataFrame]) -> DataFrame:
    all_cols = list(dict.fromkeys(c for v in DEATHS_VARIANTS.values() for c in v))
    frames = [project_to_spec(inputs[r], all_cols) for r in sorted(inputs) if accepts(r)]
    df = union_all(frames)
    primary = F.lower(F.col("source_file")).startswith(DEATHS_PRIMARY_PREFIX)
    first, second = DEATHS_VARIANTS["dodsaars"], DEATHS_VARIANTS["dodsaasg"]
    exprs = {}
    for name, a, b in zip(DEATHS_COLUMNS, first, second):
        exprs[name] = F.col(a) if a == b else F.when(primary, F.col(a)).otherwise(F.col(b))
    return select_contract(df, SPEC, exprs)


def bounds_input(inputs: dict[str, DataFrame]) -> DataFrame:
    return build(inputs)
