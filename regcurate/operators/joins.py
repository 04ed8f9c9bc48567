"""Period-aligned record/diagnosis join.

A record file of one period pairs with the diagnosis file of the *same*
period and register only: record ids repeat across years and registers.
All register pairs are normalised to one schema first and joined in *one*
equi-join on ``(register, period, record_id)`` -- one shuffle for all five
registers instead of five joins, and the alignment is in the join keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALIGN_KEYS = ("register", "period", "record_id")


def normalise(df: DataFrame, renames: dict[str, str], register: str, period: F.Column,
              source_alias: str) -> DataFrame:
    """Rename raw -> curated columns from a map, tag the register and period."""
    cols = [F.col(raw).alias(cur) for cur, raw in renames.items()]
    return df.select(F.lit(register).alias("register"), period.alias("period"), *cols,
                     F.col("source_file").alias(source_alias))


def aligned_join(records: DataFrame, diagnoses: DataFrame, keys=ALIGN_KEYS) -> DataFrame:
    """Inner equi-join, many-to-many, on the alignment keys; AQE's skew join
    splits a hot key on either side."""
    return records.join(diagnoses, list(keys), "inner")


def key_totals(records: DataFrame, diagnoses: DataFrame, record_sums: dict[str, Column],
               diagnosis_sums: dict[str, Column], keys=ALIGN_KEYS,
               by: tuple[str, ...] = ()) -> DataFrame:
    """Per alignment key the rows of both sides (``n_records``, ``n_diagnoses``)
    and sums over each side's rows: whatever the inner join would count is a
    product of these, so no row is joined. One tagged union, one aggregate.

    With ``by`` (columns of the records) the records are split further and
    ``n_diagnoses`` is given to each part of a key."""
    zero = F.lit(0).cast("long")
    sides = []
    for df, own, other, mine in ((records, record_sums, diagnosis_sums, True),
                                 (diagnoses, diagnosis_sums, record_sums, False)):
        sides.append(df.select(
            *keys, *[F.col(c) if mine else F.lit(None).cast("string").alias(c) for c in by],
            F.lit(int(mine)).cast("long").alias("n_records"),
            F.lit(int(not mine)).cast("long").alias("n_diagnoses"),
            *[c.cast("long").alias(n) for n, c in own.items()], *[zero.alias(n) for n in other]))
    sums = ["n_records", "n_diagnoses", *record_sums, *diagnosis_sums]
    total = sides[0].unionByName(sides[1]).groupBy(*keys, *by).agg(
        *[F.sum(s).alias(s) for s in sums])
    if by:     # aggregated rows only: as many to a key as it has values of ``by``
        over = Window.partitionBy(*keys)
        total = total.withColumn("n_diagnoses", F.sum("n_diagnoses").over(over))
    return total
