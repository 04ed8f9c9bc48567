"""T-2 diagnoses: five register pairs, normalised, unioned, joined once.

For every pair (records register, diagnoses register) both sides are renamed
to one schema from the pair's column map, tagged with the register and the
file period, and filtered on their keys (records: record id and person id;
diagnoses: record id). The five record sides and the five diagnosis sides
are each unioned and joined in one inner equi-join on
``(register, period, record_id)``: one shuffle for all pairs; AQE's skew join
splits a hot record id on either side. Counts over the joined rows need no join,
see :func:`counts`.

``patient_icd8`` is both sides of its pair (a self-join: a repeated record
id multiplies). The covered period is taken on the filtered records, before
the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import non_empty, period_from_file_name
from ..operators.joins import ALIGN_KEYS, aligned_join, key_totals, normalise
from ..operators.landing import union_all
from ..specs.curated import DIAGNOSIS_PAIRS, table
from ..specs.registers import spec as register_spec
from ._common import select_contract

SPEC = table("diagnoses")
INPUTS = tuple(sorted({DIAGNOSIS_PAIRS[p][s][0] for p in DIAGNOSIS_PAIRS
                       for s in ("records", "diagnoses")}))


def _period(df: DataFrame, register: str) -> F.Column:
    if "period" in df.columns:
        return F.col("period")
    rs = register_spec(register)
    return period_from_file_name(F.col("source_file"), rs.name, rs.dated)


def records(inputs: dict[str, DataFrame]) -> DataFrame:
    """Normalised, key-filtered record sides of all pairs present."""
    frames = []
    for pair, sides in DIAGNOSIS_PAIRS.items():
        reg, cols = sides["records"]
        if reg not in inputs:
            continue
        df = inputs[reg]
        frames.append(
            normalise(df, cols, pair, _period(df, reg), "record_source_file")
            .where(non_empty("record_id") & non_empty("person_id")))
    return union_all(frames)


def diagnoses(inputs: dict[str, DataFrame]) -> DataFrame:
    frames = []
    for pair, sides in DIAGNOSIS_PAIRS.items():
        reg, cols = sides["diagnoses"]
        if reg not in inputs:
            continue
        df = inputs[reg]
        frames.append(
            normalise(df, cols, pair, _period(df, reg), "diagnosis_source_file")
            .where(non_empty("record_id")))
    return union_all(frames)


def missing_pairs(inputs: dict[str, DataFrame]) -> list[str]:
    """Pairs that contribute no rows because a register is absent."""
    return [p for p, s in DIAGNOSIS_PAIRS.items()
            if s["records"][0] not in inputs or s["diagnoses"][0] not in inputs]


def build_with_register(inputs: dict[str, DataFrame]) -> DataFrame:
    """The joined rows plus the ``register`` tag (for per-register profiles)."""
    joined = aligned_join(records(inputs), diagnoses(inputs))
    return joined.select("register", *SPEC.names)


def build_by_part(inputs: dict[str, DataFrame]) -> DataFrame:
    """The joined rows plus the register and period they were joined in."""
    joined = aligned_join(records(inputs), diagnoses(inputs))
    return joined.select(*SPEC.names, "register", "period")


def build(inputs: dict[str, DataFrame], observe=None) -> DataFrame:
    """``observe=(Observation, [metrics])`` is evaluated on the filtered
    records -- where the covered period is defined -- in the same pass."""
    rec = records(inputs)
    if observe is not None:
        obs, metrics = observe
        rec = rec.observe(obs, *metrics)
    # sorted by the key whose first bytes tell most rows apart
    joined = aligned_join(rec, diagnoses(inputs), tuple(reversed(ALIGN_KEYS)))
    return select_contract(joined, SPEC, {})


def counts(inputs: dict[str, DataFrame], by: tuple[str, ...] = (), record_sums=None,
           diagnosis_sums=None) -> DataFrame:
    """Per alignment key (and ``by``) the rows of both sides; the joined rows are
    ``n_records * n_diagnoses``."""
    return key_totals(records(inputs), diagnoses(inputs), record_sums or {},
                      diagnosis_sums or {}, by=by)


def record_columns() -> set[str]:
    """Curated columns that come from the records."""
    return {*next(iter(DIAGNOSIS_PAIRS.values()))["records"][1], "record_source_file"}


def bounds_input(inputs: dict[str, DataFrame]) -> DataFrame:
    return records(inputs)
