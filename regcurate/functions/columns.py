"""Column functions (no UDFs): everything here compiles to Catalyst expressions
and stays inside whole-stage codegen."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs.curated import NO_CATEGORY, Era

_EXT = r"\.[^./]+$"   # any single extension: .sas7bdat, .csv, .parquet


def non_empty(c: Column | str) -> Column:
    """Key filter: drop null and empty-string keys (both tokens mean missing)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != F.lit(""))


def base_name(path: Column | str) -> Column:
    """Last path segment, like ``basename``."""
    path = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(path, "/"), -1)


def extract_name(path: Column | str) -> Column:
    """Name of the extract a file belongs to: the file's own or, for a part of an
    extract kept as a folder (``bef198512.parquet/part-*``), the folder's."""
    path = F.col(path) if isinstance(path, str) else path
    part = path.rlike(r"[^/]\.(parquet|csv)/part-[^/]*$")
    return F.when(part, F.element_at(F.split(path, "/"), -2)).otherwise(base_name(path))


def year_from_file_name(source_file: Column | str, dataset: str) -> Column:
    """Digits after ``<dataset>`` in a file name; null when the name has none.

    Anchored and with the dot escaped: ``ind2001.sas7bdat`` -> ``2001``,
    ``ind.sas7bdat`` -> null, ``xind2001.sas7bdat`` -> null.
    """
    source_file = F.col(source_file) if isinstance(source_file, str) else source_file
    pattern = "^" + re.escape(dataset) + "([0-9]+)" + _EXT
    return F.nullif(F.regexp_extract(source_file, pattern, 1), F.lit(""))


def period_from_file_name(source_file: Column | str, dataset: str, dated: bool) -> Column:
    """Landing period: the digits of a dated file, ``"0"`` for an undated one.

    Undated registers (``patient_icd8``) are ``"0"`` whatever their name ends
    with; a dated register's file without digits is an undated copy -> ``"0"``.
    """
    if not dated:
        return F.lit("0")
    return F.coalesce(year_from_file_name(source_file, dataset), F.lit("0"))


def dataset_from_file_name(file_name: Column | str, dated: bool) -> Column:
    """Register name of a file: letters/underscores before the period digits
    (dated), or the whole stem (undated). Null when a dated name has no digits."""
    file_name = F.col(file_name) if isinstance(file_name, str) else file_name
    if dated:
        return F.nullif(F.regexp_extract(file_name, "^([A-Za-z_]+)[0-9]+" + _EXT, 1), F.lit(""))
    return F.nullif(F.regexp_extract(file_name, "^(.+)" + _EXT, 1), F.lit(""))


def dated_period(file_name: Column | str) -> Column:
    file_name = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.nullif(F.regexp_extract(file_name, "^[A-Za-z_]+([0-9]+)" + _EXT, 1), F.lit(""))


def recode_gender(c: Column | str) -> Column:
    """``"1"`` -> ``m``; null stays null; anything else (2, 9, ...) -> ``f``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(None).cast("string")).when(c == "1", "m").otherwise("f")


def _era_conditions(year: Column, eras: Sequence[Era]):
    """Yield (condition, column name) per era; comparisons are on strings.

    A null year makes every condition null, i.e. false, so it falls through
    to the default -- as a ``case_when`` on a character year does.
    """
    for era in eras:
        bounds = [(year >= F.lit(era.since)) if era.since else None,
                  (year <= F.lit(era.up_to)) if era.up_to else None,
                  (year < F.lit(era.below)) if era.below else None]
        yield reduce(lambda a, b: a & b, [b for b in bounds if b is not None]), era.column


def era_source(year: Column | str, eras, default: str) -> Column:
    """Name of the column that holds the value for this year."""
    year = F.col(year) if isinstance(year, str) else year
    out = None
    for cond, name in _era_conditions(year, eras):
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(default))


def era_value(year: Column | str, eras, default: str) -> Column:
    """Row-wise lookup of the column named by :func:`era_source` -- a second
    ``when`` chain over the same conditions returning the column itself."""
    year = F.col(year) if isinstance(year, str) else year
    out = None
    for cond, name in _era_conditions(year, eras):
        out = F.when(cond, F.col(name)) if out is None else out.when(cond, F.col(name))
    return out.otherwise(F.col(default))


def atc_category(atc: Column | str) -> Column:
    """First letter of the ATC code; missing or empty code -> ``_none``."""
    atc = F.col(atc) if isinstance(atc, str) else atc
    return F.coalesce(F.nullif(F.substring(atc, 1, 1), F.lit("")), F.lit(NO_CATEGORY))
