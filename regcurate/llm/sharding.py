"""Consistent-hash ring with virtual nodes and bounded loads, as DataFrame
expressions.

Shards own ``vnodes`` positions each on a ring of 2**60 places; a row belongs to
the first position clockwise of its key. A shard takes at most its bound of
rows; rows beyond it continue clockwise to the next shard with room. All rows
of an arc (the stretch before one ring position) see the same shards in the
same order, so the walk is done once per arc, on row counts: a fold over the
ring, whose size is fixed by the parameters, gives the stretches of each arc's
rows that every shard takes. Rows then look up their stretch by rank.

With ``slack`` 0 the bounds are the two whole numbers next to rows / shards, so
that row counts differ by at most one; a larger slack moves fewer rows.

Defined results: a NULL text counts as empty; a NULL doc_id is a key of its
own; rows equal in doc_id and text stand in any order next to each other; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RING = 1 << 60
CELLS = 4096


def _place(label: str) -> int:
    return int(hashlib.md5(label.encode()).hexdigest()[:15], 16)


def place(label: Column) -> Column:
    """Ring place of a label: 60 bits of its MD5."""
    return F.conv(F.substring(F.md5(label.cast("binary")), 1, 15), 16, 10).cast("long")


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes, clockwise."""
    return sorted((_place(f"shard-{s}-{v}"), s) for s in range(shards) for v in range(vnodes))


def _constant(values: list[int], kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def arc_of(at: Column, nodes: list[tuple[int, int]]) -> Column:
    """Index of the first node at or after a place (0 again past the last): a
    cell table leaves only the nodes of one cell to compare."""
    places = [p for p, _ in nodes]
    width = RING // CELLS
    first, k = [], 0
    for cell in range(CELLS):
        while k < len(places) and places[k] < cell * width:
            k += 1
        first.append(k)
    most = max(b - a for a, b in zip(first, [*first[1:], len(places)]))
    table, start = _constant([*places, *[RING] * most], "bigint"), F.get(
        _constant(first, "int"), F.shiftright(at, 48).cast("int"))
    index = start
    for j in range(most):
        index = index + F.when(F.get(table, start + j) < at, 1).otherwise(0)
    return (index % len(places)).cast("int")


_STATE = "array<struct<arc:int,lo:bigint,hi:bigint,shard:int>>"


def _walk(arcs: Column, bounds: Column, owners: Column, n: int) -> Column:
    """Fold over the arcs clockwise: every shard takes what it has room for, in
    the order in which its positions follow the arc."""
    def at_shard(arc):
        def step(a, s):
            room = F.get(a["room"], s)
            take = F.least(a["left"], room)
            return F.when(take <= 0, a).otherwise(F.struct(
                F.transform(a["room"], lambda r, k: F.when(k == s, r - take).otherwise(r))
                .alias("room"),
                (a["left"] - take).alias("left"), (a["lo"] + take).alias("lo"),
                F.concat(a["out"], F.array(F.struct(
                    arc["arc"].alias("arc"), a["lo"].alias("lo"), (a["lo"] + take).alias("hi"),
                    s.alias("shard")))).alias("out")))
        return step

    def at_arc(acc, arc):
        order = F.array_distinct(F.slice(F.concat(owners, owners), arc["arc"] + 1, F.lit(n)))
        done = F.aggregate(order, F.struct(
            acc["room"].alias("room"), arc["n"].alias("left"), F.lit(0).cast("long").alias("lo"),
            acc["out"].alias("out")), at_shard(arc))
        return F.get(F.transform(F.array(done), lambda d: F.struct(
            d["room"].alias("room"), d["out"].alias("out"))), F.lit(0))

    start = F.struct(bounds.alias("room"), F.expr(f"cast(array() as {_STATE})").alias("out"))
    return F.aggregate(arcs, start, at_arc, lambda acc: acc["out"])


def assign(docs: DataFrame, shards: int = 40, vnodes: int = 32, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs``."""
    nodes = ring(shards, vnodes)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    label = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                        F.col("text_crc32").cast("string"))
    rows = rows.withColumn("at", place(label))
    rows = rows.withColumn("arc", arc_of(F.col("at"), nodes))

    arcs = rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n"))     # at most one row per node
    whole = arcs.agg(F.array_sort(F.collect_list(F.struct("arc", "n"))).alias("arcs"),
                     F.sum("n").alias("total"))
    if slack > 0:
        bound = F.ceil(F.col("total") * (1 + slack) / shards).cast("long")
        bounds = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: bound)
    else:
        each, over = F.expr(f"total div {shards}"), F.col("total") % shards
        bounds = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                             lambda k: each + F.when(k < over, 1).otherwise(0).cast("long"))
    owners = _constant([s for _, s in nodes], "int")
    taken = (whole.where("total > 0")
             .select(F.explode(_walk(F.col("arcs"), bounds, owners, len(nodes))).alias("t"))
             .select("t.*"))
    before = Window.partitionBy("shard").orderBy("arc", "lo").rowsBetween(
        Window.unboundedPreceding, -1)
    taken = taken.withColumn("slot0", F.coalesce(F.sum(F.col("hi") - F.col("lo")).over(before),
                                                 F.lit(0)))
    stretches = taken.groupBy("arc").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", "shard", "slot0"))).alias("stretches"))

    rank = Window.partitionBy("arc").orderBy("at", "doc_id", "text_crc32", "size")
    rows = rows.withColumn("x", (F.row_number().over(rank) - 1).cast("long"))
    # at most shards * vnodes rows whatever the input: bounded by the parameters
    found = rows.join(F.broadcast(stretches), "arc").withColumn("s", F.get(F.filter(
        "stretches", lambda s: (s["lo"] <= F.col("x")) & (F.col("x") < s["hi"])), F.lit(0)))
    return found.select("doc_id", "size", "text_crc32", F.col("s.shard").alias("shard"),
                        (F.col("s.slot0") + F.col("x") - F.col("s.lo")).cast("long").alias("slot"))
