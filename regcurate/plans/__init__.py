"""Curated-table plans (T-1..T-8): one module per table.

Single-register plans take that register's DataFrame; ``deaths`` and
``diagnoses`` take a ``{register: DataFrame}`` dict.
"""

from . import (deaths, diagnoses, education, employment, family_income, income, population,
               prescriptions)

PLANS = {
    "deaths": deaths,
    "diagnoses": diagnoses,
    "education": education,
    "employment": employment,
    "family_income": family_income,
    "income": income,
    "population": population,
    "prescriptions": prescriptions,
}

MULTI_INPUT = {"deaths", "diagnoses"}


def accepts(name: str, register: str) -> bool:
    """Whether a landed register is an input of curated table ``name``."""
    mod = PLANS[name]
    return mod.accepts(register) if hasattr(mod, "accepts") else register in mod.INPUTS


def build(name: str, inputs: dict, **kw):
    """Build curated table ``name`` from ``{register: DataFrame}``."""
    mod = PLANS[name]
    if name in MULTI_INPUT:
        return mod.build(inputs, **kw)
    return mod.build(inputs[mod.INPUTS[0]], **kw)


def bounds_input(name: str, inputs: dict):
    mod = PLANS[name]
    if name in MULTI_INPUT:
        return mod.bounds_input(inputs)
    return mod.bounds_input(inputs[mod.INPUTS[0]])
