"""Shared pieces of the curated-table plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs.curated import TableSpec


def select_contract(df: DataFrame, spec: TableSpec, exprs: dict[str, Column]) -> DataFrame:
    """Final projection in contract order; a name without an expression is a
    column of ``df`` of the same name."""
    return df.select(*[(exprs[n] if n in exprs else F.col(n)).alias(n) for n in spec.names])


def renamed(renames: dict[str, str]) -> dict[str, Column]:
    """curated name -> raw column, from a rename map."""
    return {cur: F.col(raw) for cur, raw in renames.items()}
