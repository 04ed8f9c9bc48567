"""First-file-wins deduplication.

Files are taken in name order (a missing name first); a row of a later file is
kept only if its key did not occur in any earlier file. *All* rows of the key
inside its first file stay (rank semantics, not row_number).

The file names are metadata: every file gets an integer ordinal, so the first
file of a key is a ``min`` over integers -- a hash aggregate with map-side
merging, in which a hot key costs one row per map task. The rows are matched
back by an equi-join on (key, ordinal): rows of later files hash elsewhere and
fall out, and AQE's skew join splits a hot (key, file).

Nothing runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def file_ordinals(df: DataFrame, order: str = "source_file") -> DataFrame:
    """``_file, _ordinal``: one row per file, numbered in name order."""
    by_name = Window.orderBy(F.col("_file").asc_nulls_first())
    return df.select(F.col(order).alias("_file")).distinct() \
        .withColumn("_ordinal", F.row_number().over(by_name))


def with_ordinal(df: DataFrame, order: str = "source_file") -> DataFrame:
    """``df`` and the ``_ordinal`` of each row's file. The broadcast side has one
    row per extract file, no more than the listing the driver plans the scan
    from."""
    files = F.broadcast(file_ordinals(df, order))
    return df.join(files, F.col(order).eqNullSafe(F.col("_file"))).drop("_file")


def first_file_wins(df: DataFrame, key: str, order: str = "source_file") -> DataFrame:
    """The rows of each key's first file."""
    ranked = with_ordinal(df, order)
    firsts = ranked.groupBy(F.col(key).alias("_key")).agg(F.min("_ordinal").alias("_first"))
    first = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_ordinal") == F.col("_first"))
    return ranked.join(firsts, first).select(*[F.col(f"`{c}`") for c in df.columns])


def first_file_wins_window(df: DataFrame, key: str, order: str = "source_file") -> DataFrame:
    """The same rows by ``rank`` over the key: one shuffle, but all rows of a key
    in one task, so only for keys known to be small."""
    w = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_first())
    return df.withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")


def rows_in_first_file(df: DataFrame, key: str, order: str = "source_file") -> DataFrame:
    """``_ordinal, _rows`` per key: its first file and how many rows it has
    there, without fetching a row. Ordinal and count share one integer, so that
    both aggregates are hash aggregates."""
    per_file = with_ordinal(df.select(key, order), order).groupBy(key, "_ordinal").count()
    packed = F.min(F.shiftleft(F.col("_ordinal").cast("long"), 40) + F.col("count")).alias("_p")
    return per_file.groupBy(key).agg(packed).select(
        key, F.shiftright("_p", 40).cast("int").alias("_ordinal"),
        F.col("_p").bitwiseAND(F.lit((1 << 40) - 1)).alias("_rows"))


def one_row_per_key(df: DataFrame, key: str, order: str = "source_file") -> DataFrame:
    """Strict variant: exactly one row per key -- the first file's row that
    sorts first on all columns (nulls first), as ``min(struct)`` with map-side
    merging: a hot key costs one row per map task."""
    others = [c for c in df.columns if c not in (key, order)]
    packed = F.struct(*[F.col(c) for c in [order] + others]).alias("_row")
    agg = df.groupBy(key).agg(F.min(packed).alias("_row"))
    return agg.select(*[F.col(key) if c == key else F.col("_row." + c).alias(c)
                        for c in df.columns])
