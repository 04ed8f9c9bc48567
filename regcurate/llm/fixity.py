"""Merkle fixity audit of archive replicas.

Each archive (a WARC file) is a tree: records are hashed, the records of one
range of ``width`` byte offsets are hashed in offset order into a range node,
and ``fanout`` neighbouring nodes into the node above, up to one root. Two
replicas are compared root by root; only the children of differing nodes are
read on the next level, down to the records.

Every level is a staged table, so the descent reads tables, never recomputes
them, and each step is one join on (archive, range). Records at one offset are
merged by order-free sums before they are hashed, so repeated rows do not
gather in one value.

Defined results: a NULL payload counts as empty; records without archive or
offset cannot be placed and are void; several records at one offset of a
replica are one place, which differs if any of them does; a record id that
differs with equal payload is no damage; two empty replicas agree; payloads of any
length are hashed whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regcurate.llm.shared import staged

WIDTH, FANOUT = 1 << 18, 16


def _number(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")


def digest_of(payload: Column) -> Column:
    """SHA-256 of a record's bytes, in hex; NULL counts as empty."""
    return F.sha2(F.coalesce(payload, F.lit("")).cast("binary"), 256)


def places(records: DataFrame) -> DataFrame:
    """archive, at, record_id, leaf: one row per offset that holds records.
    Records come with their payload, or with its ``payload_sha256`` where that
    was taken before, so that no payload is moved."""
    digest = F.col("payload_sha256") if "payload_sha256" in records.columns else \
        digest_of(F.col("payload"))
    merged = (records.where("archive is not null and at is not null")
              .select("archive", "at", "record_id", digest.alias("digest"))
              .groupBy("archive", "at").agg(
                  F.min("record_id").alias("record_id"), F.count(F.lit(1)).alias("n"),
                  *[F.sum(_number(F.col("digest"), 1 + 15 * k)).cast("string").alias(f"d{k}")
                    for k in range(4)], F.min("digest").alias("least")))
    leaf = F.sha2(F.concat_ws(":", "n", "d0", "d1", "d2", "d3", "least").cast("binary"), 256)
    return merged.select("archive", "at", "record_id", leaf.alias("leaf"))


def _node(children: Column) -> Column:
    ordered = F.transform(F.array_sort(children),
                          lambda c: F.concat_ws(":", c["part"].cast("string"), c["hash"]))
    return F.sha2(F.array_join(ordered, ",").cast("binary"), 256)


def _above(nodes: DataFrame, fanout: int) -> DataFrame:
    return nodes.groupBy("archive", F.expr(f"part div {fanout}").alias("part_up")).agg(
        _node(F.collect_list(F.struct("part", "hash"))).alias("hash")) \
        .withColumnRenamed("part_up", "part")


class Tree:
    """Staged levels of one replica: records, then ranges up to the roots."""

    def __init__(self, records: DataFrame, width: int, fanout: int, levels: int,
                 leaves: DataFrame | None = None):
        self.records = leaves if leaves is not None else staged(places(records), "fixity-records")
        nodes = self.records.groupBy("archive", F.expr(f"at div {width}").alias("part")).agg(
            _node(F.collect_list(F.struct(F.col("at").alias("part"),
                                          F.col("leaf").alias("hash")))).alias("hash"))
        self.levels = [staged(nodes, "fixity-level")]
        for _ in range(levels):
            self.levels.append(staged(_above(self.levels[-1], fanout), "fixity-level"))


def _differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(archive, part) of nodes whose hashes differ or that one side lacks."""
    a, b = ours.withColumnRenamed("hash", "ours"), theirs.withColumnRenamed("hash", "theirs")
    return a.join(b, ["archive", "part"], "full_outer") \
        .where(~F.col("ours").eqNullSafe(F.col("theirs"))).select("archive", "part")


def _below(nodes: DataFrame, differing: DataFrame, fanout: int) -> DataFrame:
    up = differing.withColumnRenamed("part", "up")
    return nodes.withColumn("up", F.expr(f"part div {fanout}")) \
        .join(up, ["archive", "up"], "left_semi").drop("up")


def audit(ours: DataFrame, theirs: DataFrame, width: int = WIDTH,
          fanout: int = FANOUT) -> DataFrame:
    """archive, at, record_id, status ('altered', 'missing' in theirs, 'extra')
    of every place where two replicas (archive, at, record_id and payload or
    payload_sha256) differ."""
    mine, yours = (staged(places(r), "fixity-records") for r in (ours, theirs))
    last = max([r[0] or 0 for r in
                mine.agg(F.max("at")).union(yours.agg(F.max("at"))).collect()])
    levels, top = 0, last // width
    while top > 0:
        top, levels = top // fanout, levels + 1
    a, b = (Tree(None, width, fanout, levels, leaves) for leaves in (mine, yours))
    found = _differing(a.levels[-1], b.levels[-1])
    for k in range(levels - 1, -1, -1):
        found = staged(found, "fixity-differing")
        found = _differing(_below(a.levels[k], found, fanout), _below(b.levels[k], found, fanout))
    found = staged(found, "fixity-differing")

    def suspects(records: DataFrame, side: str) -> DataFrame:
        return records.withColumn("part", F.expr(f"at div {width}")) \
            .join(found, ["archive", "part"], "left_semi") \
            .select("archive", "at", F.col("record_id").alias(f"{side}_id"),
                    F.col("leaf").alias(f"{side}_leaf"))

    both = suspects(a.records, "our").join(suspects(b.records, "their"), ["archive", "at"],
                                           "full_outer")
    status = F.when(F.col("their_leaf").isNull(), "missing") \
        .when(F.col("our_leaf").isNull(), "extra").otherwise("altered")
    return both.where(~F.col("our_leaf").eqNullSafe(F.col("their_leaf"))).select(
        "archive", "at", F.coalesce("our_id", "their_id").alias("record_id"),
        status.alias("status"))
