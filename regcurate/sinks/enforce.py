"""Contract enforcement: a curated table split, in one pass, into the rows that
keep its declared contract and the rejected ones with the rules they break.

Every row gets the list of its broken rules (not null, format, enum, declared
category; :func:`regcurate.operators.profile.contract_rules`). One write deals
the rows to two folders, and both are published as one version: the table's
readers see the clean rows, :func:`read_rejects` the others. Rows are neither
lost nor changed: both parts together are the table without enforcement. Counts,
bounds and violations per rule are observed on that same write.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import plans
from ..operators.profile import contract_rules
from ..specs.curated import TABLES, TableSpec
from .versions import Manifest, Published
from .writers import sidecar

_PART, _RULES = "part", "broken_rules"
CLEAN, REJECTS = "clean", "rejects"


def with_broken_rules(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` and ``broken_rules``, the ``column:rule`` names a row breaks, in the
    contract's order."""
    rules = [F.when(F.coalesce(broken, F.lit(False)), F.lit(f"{column}:{rule}"))
             for column, rule, broken in contract_rules(spec)]
    broken = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
    return df.withColumn(_RULES, broken)


def publish_enforced(name: str, inputs: dict[str, DataFrame], root: str) -> Manifest:
    """Build a curated table and publish it with its rejects. The sidecar's size
    and period are those of the clean rows; ``rejected`` tells the rejected rows
    and how many rows break each rule."""
    spec = TABLES[name]
    df = with_broken_rules(plans.build(name, inputs), spec)
    table = Published(df.sparkSession, root)
    base = table.manifest()
    version = base.version + 1 if base else 1
    clean = F.size(_RULES) == 0
    first, last = spec.period_columns
    names = [f"{c}:{r}" for c, r, _ in contract_rules(spec)]
    seen = Observation()
    split = df.withColumn(_PART, F.when(clean, F.lit(CLEAN)).otherwise(F.lit(REJECTS))).observe(
        seen, F.count_if(clean).alias("rows"), F.count_if(~clean).alias("rejected"),
        F.min(F.when(clean, F.col(first))).alias("first"),
        F.max(F.when(clean, F.col(last))).alias("last"),
        *[F.count_if(F.array_contains(_RULES, n)).alias(f"v{i}") for i, n in enumerate(names)])
    segments = [replace(s, kind="data" if s.keys[_PART] == CLEAN else REJECTS)
                for s in table.write(split, version, partition_by=(_PART,))]
    got = seen.get
    meta = sidecar(spec, int(got["rows"] or 0), got["first"], got["last"], "parquet")
    meta["rejected"] = {"size": int(got["rejected"] or 0),
                        "rules": {n: int(got[f"v{i}"] or 0) for i, n in enumerate(names)}}
    return table.publish(base, segments, meta)


def read_rejects(name: str, table: Published, found: Manifest) -> DataFrame:
    """The rejected rows of a version, with the rules they break."""
    spec = TABLES[name]
    schema = T.StructType([
        *[T.StructField(c, T.StringType()) for c in (*spec.names, *spec.partition_by)],
        T.StructField(_RULES, T.ArrayType(T.StringType()))])
    return table.read(found.of(REJECTS), schema)
