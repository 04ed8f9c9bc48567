"""Profiles: covered period, row counts, group counts, file inventory,
landed-vs-curated reconciliation and the column-contract report.

All are plain aggregates (partial aggregation before the shuffle, so a hot
group costs one row per map task). Combining per-table results uses
``unionByName`` plus a second aggregate, never a cross join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs.curated import TableSpec

# start values of the fold over files in the source; an empty table keeps them
FIRST_START = "9999-12-31"
LAST_START = "0001-01-01"


def group_count(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """``group_by(column) -> n``."""
    return df.groupBy(F.col(column).alias(alias or column)).agg(F.count(F.lit(1)).alias("n"))


def coverage_row(name: str, df: DataFrame, first_col: str, last_col: str) -> DataFrame:
    """One row ``(table_name, first, last, rows)`` of a table, in one aggregate."""
    return df.agg(F.min(first_col).alias("first"), F.max(last_col).alias("last"),
                  F.count(F.lit(1)).alias("rows")) \
        .select(F.lit(name).alias("table_name"), "first", "last", "rows")


def coverage_of_parts(name: str, bounds_df: DataFrame, first_col: str, last_col: str,
                      counts_df: DataFrame, rows: Column) -> DataFrame:
    """The same where the period is defined on other rows than the table's, and
    the table's rows are a sum over counts."""
    b = bounds_df.agg(F.min(first_col).alias("first"), F.max(last_col).alias("last")) \
        .select("first", "last", F.lit(0).cast("bigint").alias("rows"))
    r = counts_df.agg(F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("rows")) \
        .select(F.lit(None).cast("string").alias("first"),
                F.lit(None).cast("string").alias("last"), "rows")
    return b.unionByName(r).agg(F.min("first").alias("first"), F.max("last").alias("last"),
                                F.sum("rows").alias("rows")) \
        .select(F.lit(name).alias("table_name"), "first", "last", "rows")


def union_rows(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), list(frames))


def file_inventory(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Per register: number of files, first/last period, the period list, the
    file list and rows. ``files`` (dataset, period, file_name) is the listing, so
    files without rows count too; ``rows`` has file_name and rows.

    With ``=`` the optimizer would derive tests of the counted files' names from the
    join and push them below the counts, to be made once a row; ``<=>`` derives none."""
    found = rows.where(F.col("file_name").isNotNull()).withColumnRenamed("file_name", "_file")
    both = files.join(found, F.col("file_name").eqNullSafe(F.col("_file")), "left")
    return both.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.min("period").alias("first_period"),
        F.max("period").alias("last_period"),
        F.concat_ws(",", F.sort_array(F.collect_set("period"))).alias("periods"),
        F.concat_ws(",", F.sort_array(F.collect_list("file_name"))).alias("source_files"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
    )


def _reconciled(name: str, both: DataFrame) -> DataFrame:
    """Sum of landed_rows and curated_rows per source file."""
    return both.groupBy("source_file").agg(
        F.sum("landed_rows").cast("bigint").alias("landed_rows"),
        F.sum("curated_rows").cast("bigint").alias("curated_rows"),
    ).select(F.lit(name).alias("table_name"), "source_file", "landed_rows", "curated_rows",
             (F.col("landed_rows") - F.col("curated_rows")).alias("dropped_rows"))


def rows_per_file(landed: DataFrame, kept: Column, name: str) -> DataFrame:
    """Landed against curated rows per ``source_file`` of a table that only
    filters its rows: one scan, one aggregate."""
    return _reconciled(name, landed.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("landed_rows"), F.count_if(kept).alias("curated_rows")))


def reconcile_counts(landed: DataFrame, curated: DataFrame, name: str) -> DataFrame:
    """The same where the curated rows per file (``source_file, curated_rows``)
    were counted on their own."""
    left = landed.groupBy("source_file").agg(F.count(F.lit(1)).alias("landed_rows")) \
        .withColumn("curated_rows", F.lit(0).cast("long"))
    right = curated.select("source_file", F.lit(0).cast("long").alias("landed_rows"),
                           "curated_rows")
    return _reconciled(name, left.unionByName(right))


def contract_rules(spec: TableSpec) -> list[tuple[str, str, Column]]:
    """(column, rule, violation predicate) for every declared contract."""
    rules = []
    for c in spec.columns:
        col = F.col(c.name)
        if not c.nullable:
            rules.append((c.name, "not_null", col.isNull() | (col == "")))
        if c.format:
            rules.append((c.name, "format", (col != "") & ~col.rlike(c.format)))
        if c.enum:
            rules.append((c.name, "enum", ~col.isin(*c.enum)))
    cats = spec.extra.get("categories")
    if cats and "atc_category" in spec.partition_by:
        col = F.col("atc_category")
        rules.append(("atc_category", "declared_category", ~col.isin(*cats, "_none")))
    return rules


def _stacked(wide: DataFrame, spec: TableSpec, rules) -> DataFrame:
    args = ", ".join(f"'{c}', '{r}', v{i}" for i, (c, r, _) in enumerate(rules))
    long = wide.selectExpr(
        f"stack({len(rules)}, {args}) AS (column_name, rule, violations)")
    return long.select(F.lit(spec.key).alias("table_name"), "column_name", "rule",
                       F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def contract_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``(table_name, column_name, rule, violations)``: one pass, one
    ``count_if`` per rule, unpivoted with ``stack``."""
    rules = contract_rules(spec)
    return _stacked(df.agg(*[F.count_if(F.coalesce(pred, F.lit(False))).alias(f"v{i}")
                             for i, (_, _, pred) in enumerate(rules)]), spec, rules)


def joined_contract_report(spec: TableSpec, left: set[str], totals) -> DataFrame:
    """The report of a joined table without joining: each rule is counted per
    join key on the side its column comes from and weighted by the other side's
    rows. ``left``: columns of the records; ``totals(record_sums,
    diagnosis_sums)`` gives the per-key sums."""
    rules = contract_rules(spec)
    sums = {f"v{i}": F.coalesce(pred, F.lit(False)).cast("int")
            for i, (_, _, pred) in enumerate(rules)}
    mine = {f"v{i}" for i, (c, _, _) in enumerate(rules) if c in left}
    per_key = totals({v: c for v, c in sums.items() if v in mine},
                     {v: c for v, c in sums.items() if v not in mine})
    return _stacked(per_key.agg(*[
        F.sum(F.col(v) * F.col("n_diagnoses" if v in mine else "n_records")).alias(v)
        for v in sums]), spec, rules)


def out_of_order(table: DataFrame, keys) -> DataFrame:
    """``rows, out_of_order`` of a table read back from Parquet files: how many
    rows sort below their predecessor, within each file and from one file to the
    next in name order.

    Rows are compared where they are read, in the order of their file; what is
    shuffled is a line per run of rows that a batch held, with its ends."""
    firsts, lasts = ([f"{e}{j}" for j in range(len(keys))] for e in ("first", "last"))
    rows = table.select(F.col("_metadata.file_name").alias("f"),
                        F.col("_metadata.row_index").alias("i"),
                        *[F.col(k).alias(f) for k, f in zip(keys, firsts)])
    kinds = [f.dataType for f in rows.schema.fields[2:]]
    names = ["f", "i", "rows", "bad", *firsts, *lasts]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, [
        T.StringType(), T.LongType(), T.LongType(), T.LongType(), *kinds, *kinds])])

    def runs(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def told(a):
            return pc.fill_null(a, False).to_numpy(zero_copy_only=False)

        for batch in batches:
            if not batch.num_rows:
                continue
            f, at, *cols = batch.columns
            i = at.to_numpy()
            cut = (i[1:] != i[:-1] + 1) | told(pc.not_equal(f[1:], f[:-1]))
            fell = np.zeros(len(cut), bool)
            for c in reversed(cols):                # NULL sorts first
                a, z = c[:-1], c[1:]
                gone, none = told(a.is_null()), told(z.is_null())
                fell = told(pc.greater(a, z)) | ~gone & none \
                    | (told(pc.equal(a, z)) | gone & none) & fell
            start = np.r_[0, np.flatnonzero(cut) + 1]
            end = np.r_[start[1:], len(i)] - 1
            bad = np.add.reduceat(np.r_[False, fell & ~cut].astype("int64"), start)
            yield pa.RecordBatch.from_arrays(
                [f.take(pa.array(start)), at.take(pa.array(start)), pa.array(end - start + 1),
                 pa.array(bad), *[c.take(pa.array(start)) for c in cols],
                 *[c.take(pa.array(end)) for c in cols]], names=names)

    lines = rows.mapInArrow(runs, schema).select(
        "f", "i", "rows", "bad", F.struct(*firsts).alias("first"), F.struct(*lasts).alias("last"))
    joint = F.lag("last").over(Window.partitionBy("f").orderBy("i")) > F.col("first")
    files = lines.withColumn("bad", F.col("bad") + F.coalesce(joint.cast("int"), F.lit(0))) \
        .groupBy("f").agg(F.sum("rows").alias("rows"), F.sum("bad").alias("bad"),
                          F.min_by("first", "i").alias("first"), F.max_by("last", "i").alias("last"))
    step = F.lag("last").over(Window.orderBy("f")) > F.col("first")     # one row per file
    return files.withColumn("bad", F.col("bad") + F.coalesce(step.cast("int"), F.lit(0))).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("out_of_order"))


def family_size(population: DataFrame) -> DataFrame:
    """Persons per family id (families without an id are left out)."""
    return (population.where(F.col("family_id").isNotNull() & (F.col("family_id") != ""))
            .groupBy("family_id").agg(F.count(F.lit(1)).alias("members")))
