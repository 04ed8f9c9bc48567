"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcurate.llm.shared import staged


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)),
                           F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of every node of ``links``
    (two long columns) that is not its own component's least node.

    Each pass moves a node's larger neighbours to its least one, then its
    smaller neighbours likewise; passes are logarithmic in the longest path.
    Passes are staged tables; a node with many links meets only a pre-aggregated
    minimum and an equi-join that AQE can split."""
    a, b = (F.col(f"`{c}`") for c in links.columns[:2])
    edges = staged(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                   .where("hi > lo").distinct(), "component-edges")
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.selectExpr("hi as u", "lo as v").union(edges.selectExpr("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v as u", "m as v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v > m").selectExpr("v as hi", "m as lo") \
            .union(lowest.selectExpr("u as hi", "m as lo"))
        edges = staged(small.distinct(), "component-edges")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.selectExpr("hi as node", "lo as component")
