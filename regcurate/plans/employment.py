"""T-4 employment (register ``ras``).

The status and the industry live in different raw columns depending on the
year of the file (four status eras, three industry eras). Each row names the
column its value came from (``status_source``) and carries that column's
value (``status``): two ``when`` chains over the same string comparisons of
the year, no UDF and no map lookup. A file without a year falls to the last
era. Narrow: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import era_source, era_value, non_empty, year_from_file_name
from ..specs.curated import (INDUSTRY_DEFAULT, INDUSTRY_ERAS, STATUS_DEFAULT, STATUS_ERAS,
                             table)
from ._common import select_contract

SPEC = table("employment")
INPUTS = ("ras",)


def build(ras: DataFrame) -> DataFrame:
    df = ras.where(non_empty("PNR")).withColumn(
        "year", year_from_file_name(F.col("source_file"), "ras"))
    y = F.col("year")
    exprs = {
        "person_id": F.col("PNR"),
        "status_source": era_source(y, STATUS_ERAS, STATUS_DEFAULT),
        "status": era_value(y, STATUS_ERAS, STATUS_DEFAULT),
        "industry_source": era_source(y, INDUSTRY_ERAS, INDUSTRY_DEFAULT),
        "industry": era_value(y, INDUSTRY_ERAS, INDUSTRY_DEFAULT),
    }
    return select_contract(df, SPEC, exprs)


def bounds_input(ras: DataFrame) -> DataFrame:
    return build(ras)
