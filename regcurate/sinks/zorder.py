"""Files clustered on several keys at once.

A table in plain order serves filters on its first key only: every file holds
nearly all values of the second. Here each key is turned into a small number,
the position of its value among quantiles, the bits of these numbers are
interleaved, and the rows are range-partitioned on the result. A file then holds
a box of values, narrow in every key, and its Parquet statistics let a reader
skip it on either.

The quantiles, and the bounds of the files, come from one sample of bounded size
(SAMPLE rows, or PER_FILE for each file, keys only); they shape the files, not the
rows. So each row's keys are placed once, where it is dealt. The bits below the
interleaved ones are a row hash's, so a value with a large share of the rows spreads
over several files.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Bits per key, rows sampled for the quantiles, and for a file's bounds.
BITS, SAMPLE, PER_FILE = 8, 20_000, 100


def sampled(table: DataFrame, keys: Sequence[str], sample: int = SAMPLE) -> list[Row]:
    """The keys of about ``sample`` rows. The table is read twice, its count (from
    footers, if it is a file) and its keys."""
    n = table.count()
    rows = table.select(*keys) if n <= sample else \
        table.select(*keys).sample(sample / n, seed=1)
    return rows.limit(2 * sample).collect()


def quantiles(table: DataFrame, keys: Sequence[str], bits: int = BITS,
              sample: int = SAMPLE) -> dict[str, list[str]]:
    """Up to 2**bits - 1 ascending cuts per key, from about ``sample`` rows."""
    return cuts_of(sampled(table, keys, sample), keys, bits)


def cuts_of(got: Sequence[Row], keys: Sequence[str], bits: int = BITS) -> dict[str, list[str]]:
    """The cuts per key of sampled rows."""
    cuts = {}
    for k in keys:
        values = sorted(r[k] for r in got if r[k] is not None)
        step = [values[len(values) * i >> bits] for i in range(1, 1 << bits)] if values else []
        cuts[k] = sorted(set(step))
    return cuts


def _steps(cuts: list, bits: int) -> list[int]:
    return [1 << b for b in reversed(range(max(bits, len(cuts).bit_length())))]


def _further(at: Column, step: Column, key: Column, cuts: list, below: bool) -> Column:
    """``at``, or ``step`` cuts further where the cut there is passed."""
    cut = F.get(F.array(*map(F.lit, cuts)), at + step - F.lit(1))    # beyond the end: NULL
    return at + F.when(cut < key if below else cut <= key, step).otherwise(0)


def position(key: Column, cuts: list, bits: int = BITS, below: bool = False,
             at: Column | None = None, done: int = 0) -> Column:
    """How many of the ascending cuts are at or below the value (NULL: none), or
    truly ``below`` it, by a binary search: ``bits`` steps, more for 2**bits cuts
    or more. A search of which some steps are ``done`` goes on from ``at``."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*map(F.lit, _steps(cuts, bits)[done:]))
    return F.aggregate(steps, F.lit(0) if at is None else at,
                       lambda x, step: _further(x, step, key, cuts, below))


def placed(table: DataFrame, name: str, key: Column, cuts: list, bits: int = 0,
           below: bool = False, steps: int | None = None) -> DataFrame:
    """The table with the :func:`position` (its first ``steps``) as a column: a column
    a step, which compiles, where an expression would hold the one before twice."""
    out = table.withColumn(name, F.lit(0))
    for step in _steps(cuts, bits)[:steps] if cuts else ():
        out = out.withColumn(name, _further(F.col(name), F.lit(step), key, cuts, below))
    return out


def interleaved(positions: Sequence[Column], bits: int = BITS) -> Column:
    """The positions' bits, highest first, taken in turn."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, p in enumerate(positions):
            at = bit * len(positions) + len(positions) - 1 - i
            out = out.bitwiseOR(F.shiftleft(
                F.shiftright(p.cast("long"), bit).bitwiseAND(F.lit(1)), at))
    return out


def bounds(got: Sequence[Row], cuts: dict[str, list[str]], keys: Sequence[str], files: int,
           bits: int = BITS) -> list[int]:
    """The least dealt number (see :func:`dealt`) of every file but the first, from
    sampled rows. The hash bits of rows that share the others are taken as even."""
    low, found = 63 - bits * len(keys), Counter()
    for r in got:
        at = [0 if r[k] is None else bisect_right(cuts[k], r[k]) for k in keys]
        found[sum((p >> b & 1) << b * len(at) + len(at) - 1 - i
                  for b in range(bits) for i, p in enumerate(at))] += 1
    numbers = [(z << low) + ((2 * j + 1 << low) // (2 * n))
               for z, n in sorted(found.items()) for j in range(n)]
    return [numbers[len(numbers) * f // files] for f in range(1, files)] if numbers else []


def dealt(z: Column, tie: Column, width: int) -> Column:
    """``z`` of ``width`` bits with a row hash's highest bits below it: 63 bits."""
    return F.shiftleft(z, 63 - width).bitwiseOR(F.shiftrightunsigned(tie, width + 1))


def zordered(table: DataFrame, keys: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """The rows in ``files`` partitions clustered on all keys."""
    got = sampled(table, keys, max(SAMPLE, PER_FILE * files))
    cuts = cuts_of(got, keys, bits)
    firsts = bounds(got, cuts, keys, files, bits)
    at, out = [f"_at{i}" for i in range(len(keys))], table
    for a, k in zip(at, keys):       # columns: each is found once a row
        steps = len(_steps(cuts[k], bits)) - 1
        out = placed(out, a, F.col(k), cuts[k], bits, steps=steps)
        out = out.withColumn(a, position(F.col(k), cuts[k], bits, at=F.col(a), done=steps))
    out = out.withColumns({"_z": interleaved([F.col(a) for a in at], bits),
                           "_tie": F.xxhash64(*[F.col(f"`{c}`") for c in table.columns])})
    out = out.withColumn("_n", dealt(F.col("_z"), F.col("_tie"), bits * len(keys)))
    return placed(out, "_to", F.col("_n"), firsts).repartitionById(files, "_to") \
        .sortWithinPartitions("_z", *keys).drop(*at, "_z", "_tie", "_n", "_to")


def files_read(path_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key of a table read from Parquet files: its values, and the mean number
    of files whose bounds admit a value, which is what a filter on it reads."""
    bounds = path_rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).collect()
    parts = []
    for k in keys:
        # files that begin at or below the value, without those that end below it
        first, last = (sorted(b[f"{f}_{k}"] for b in bounds if b[f"{f}_{k}"] is not None)
                       for f in ("min", "max"))
        values = path_rows.select(F.col(k).alias("v")).where(F.col("v").isNotNull()).distinct()
        values = placed(values, "begun", F.col("v"), first)
        values = placed(values, "ended", F.col("v"), last, below=True)
        parts.append(values.agg(F.count(F.lit(1)).alias("n_values"), F.avg(
            F.col("begun") - F.col("ended")).alias("files_read")).select(
                F.lit(k).alias("key"), F.lit(len(bounds)).cast("long").alias("files"),
                "n_values", "files_read"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
