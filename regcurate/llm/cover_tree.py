"""Hard-negative mining with cover trees over norm-augmented candidates.

Every candidate x gets one more component sqrt(M**2 - |x|**2), M the largest
norm in its tree, so that all candidates lie on one sphere and a larger inner
product with an anchor is a smaller distance. A cover tree halves no cell by
coordinates: level i covers a node's members by centres more than BASE**i
apart, each with the members within BASE**i of it, the node's own centre first;
levels that would hold the centre alone are left out. Each node keeps its true
covering radius, which bounds the inner products of all members from both sides
by the angle it spans on the sphere.

An anchor descends best first, by upper bound. A node whose bounds lie outside
all of the anchor's score windows that can still improve is skipped, as is one
whose members all have a label that does not count; a leaf's members are
verified exactly, in integers.

On Spark the candidates are dealt by a hash of their id to trees of bounded size
(TREE_ROWS, TREE_BYTES), built in parallel and written as a table. Anchors go in
blocks of bounded size (BLOCK_BYTES) to all trees: first for the best rows of
their own label, then, with the windows of those positives, for the negatives.
A tree answers an anchor with at most as many rows as are asked for, and the
partial answers are merged by rank. No pairs are formed.

Defined results: rows with a NULL id, label or vector, or a NULL, NaN or infinite
component take no part; rows that share an id are one row, the least by label and
vector; equal vectors and scores are ordered by id; vectors of another length
than an anchor's are not compared with it; an anchor without positives, or a
positive without negatives in its window, gives no row; other columns are
ignored; an empty table gives an empty result. Components are whole numbers;
products beyond 2**53 are taken in Python integers.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regcurate.llm.shared import in_arrow, per_group, staged

#: Candidates of one tree: at most this many rows and about this many bytes.
TREE_ROWS, TREE_BYTES = 16_384, 16 << 20
#: Bytes of anchors sent to all trees at a time.
BLOCK_BYTES = 4 << 20
#: Ratio of the covering radii of two levels.
BASE = 1.3
#: A node of at most this many members is not split.
LEAF = 256


# --- tree -----------------------------------------------------------------------

class Tree:
    """Cover tree over the rows of ``vectors`` (n x d whole numbers). Members
    stand in leaf order, so that each node's are a slice."""

    FIELDS = ("vectors", "ids", "labels", "centre", "radius", "begin", "end", "child",
              "children", "low", "high")

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> "Tree":
        by_id = np.argsort(ids, kind="stable")
        ids, labels, vectors = ids[by_id], labels[by_id], vectors[by_id]
        x = vectors.astype(np.float64)
        norms = np.einsum("ij,ij->i", x, x)
        top = norms.max(initial=0.0)
        points = np.column_stack([x, np.sqrt(np.maximum(top - norms, 0.0))])

        def distances(centre: int, rows: np.ndarray) -> np.ndarray:
            return np.linalg.norm(points[rows] - points[centre], axis=1)

        nodes, order, at = [], np.empty(len(ids), np.int64), 0
        todo = [(0, np.arange(len(ids)), None)] if len(ids) else []
        while todo:                                    # depth first: slices nest
            centre, rows, place = todo.pop()
            far = distances(centre, rows)
            radius = float(far.max())
            if place is None:
                place = len(nodes)
                nodes.append(None)
                begin = at
            else:
                begin = at
            node = [centre, radius, begin, begin + len(rows), -1, 0,
                    labels[rows].min(), labels[rows].max()]
            nodes[place] = node
            if len(rows) <= LEAF or radius <= 1e-9 * math.sqrt(top):
                order[at:at + len(rows)] = rows
                at += len(rows)
                continue
            level = BASE ** (math.ceil(math.log(radius, BASE)) - 1)
            cells, left, far_left = [], rows, far
            c = centre
            while len(left):
                near = far_left <= level
                near[left == c] = True
                cells.append((c, left[near]))
                left = left[~near]
                if len(left):
                    c = int(left[0])
                    far_left = distances(c, left)
            cells = cls._gathered(cells)
            node[4], node[5] = len(nodes), len(cells)
            nodes.extend([None] * len(cells))
            for k in range(len(cells) - 1, -1, -1):
                todo.append((*cells[k], node[4] + k))
        tree = cls()
        tree.vectors, tree.ids, tree.labels = vectors[order], ids[order], labels[order]
        where = np.empty(len(ids), np.int64)
        where[order] = np.arange(len(ids))
        columns = list(zip(*nodes)) if nodes else [()] * 8
        tree.centre = where[np.array(columns[0], np.int64)]
        tree.radius = np.array(columns[1], np.float64)
        for name, values in zip(("begin", "end", "child", "children", "low", "high"), columns[2:]):
            setattr(tree, name, np.array(values, np.int64))
        tree._prepare()
        return tree

    @staticmethod
    def _gathered(cells: list) -> list:
        """Cells too small to be worth a bound of their own join the one before
        them, whose centre then covers both."""
        out: list = []
        for c, rows in cells:
            if out and len(out[-1][1]) + len(rows) <= LEAF // 2:
                out[-1] = (out[-1][0], np.concatenate([out[-1][1], rows]))
            else:
                out.append((c, rows))
        return out if len(out) > 1 else cells

    def _prepare(self) -> None:
        size = max(abs(int(self.vectors.max(initial=0))), abs(int(self.vectors.min(initial=0))))
        self.size, self.width = size, self.vectors.shape[1]
        self.points = self.vectors.astype(np.float64)
        norms = np.einsum("ij,ij->i", self.points, self.points)
        self.norm = math.sqrt(norms.max(initial=0.0))
        self.span = 2 * np.arcsin(np.minimum(
            1.0, self.radius / (2 * self.norm))) if self.norm else np.zeros(len(self.radius))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> "Tree":
        tree = cls()
        with np.load(io.BytesIO(blob)) as arrays:
            for f in cls.FIELDS:
                setattr(tree, f, arrays[f])
        tree._prepare()
        return tree

    def scores(self, begin: int, end: int, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products of members [begin, end) with the anchor."""
        most = int(np.abs(anchor).max(initial=0))
        if self.size * most * max(self.width, 1) < 1 << 53:
            return self.points[begin:end] @ anchor.astype(np.float64)
        rows = self.vectors[begin:end].astype(object)
        return np.array([sum(a * b for a, b in zip(r, anchor.tolist())) for r in rows], np.int64)

    def bounds(self, nodes: slice, anchor: np.ndarray, length: float
               ) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) inner product that the members of nodes can have."""
        at = self.points[self.centre[nodes]] @ anchor
        reach = self.norm * length
        if not reach:
            return at, at
        angle, span = np.arccos(np.clip(at / reach, -1.0, 1.0)), self.span[nodes]
        slack = 1e-6 * reach + 1e-6
        return (reach * np.cos(np.minimum(np.pi, angle + span)) - slack,
                reach * np.cos(np.maximum(0.0, angle - span)) + slack)

    def descend(self, anchor_id: int, anchor: np.ndarray, label: int, same: bool,
                windows: list[tuple[float, float]], most: int
                ) -> tuple[list[list[tuple[int, int]]], int]:
        """Per window [low, high] the first ``most`` (-score, id) of members with
        (``same``) or without the label; and how many members were verified."""
        found: list[list] = [[] for _ in windows]
        live, checked = [k for k, (low, high) in enumerate(windows) if low <= high], 0
        if not len(self.centre) or not live:
            return found, 0
        q = anchor.astype(np.float64)
        length = float(np.sqrt(q @ q))
        heap: list = []

        def push(nodes: slice) -> None:
            low, high = self.bounds(nodes, q, length)
            keep = np.zeros(len(low), bool)
            for k in live:
                keep |= (high >= floor[k]) & (low <= windows[k][1])
            single = self.low[nodes] == self.high[nodes]
            if same:
                keep &= (self.low[nodes] <= label) & (self.high[nodes] >= label)
            else:
                keep &= ~(single & (self.low[nodes] == label))
            for j in np.flatnonzero(keep):
                heapq.heappush(heap, (-high[j], int(low[j]) if np.isfinite(low[j]) else 0,
                                      nodes.start + int(j)))

        floor = [w[0] for w in windows]                # no score below can still count
        push(slice(0, 1))
        while heap:
            upper, lower, node = heapq.heappop(heap)
            live = [k for k in live if -upper >= floor[k]]
            if not live:
                break
            if not any(lower <= windows[k][1] for k in live):
                continue
            if self.children[node]:
                push(slice(self.child[node], self.child[node] + self.children[node]))
                continue
            begin, end = self.begin[node], self.end[node]
            checked += int(end - begin)
            score = self.scores(begin, end, anchor)
            ids, labels = self.ids[begin:end], self.labels[begin:end]
            hit = np.flatnonzero(((labels == label) == same) & (ids != anchor_id)
                                 & (score >= min(floor[k] for k in live))
                                 & (score <= max(windows[k][1] for k in live)))
            if not len(hit):
                continue
            score, ids = score[hit], ids[hit]
            for k in live:
                at = np.flatnonzero((score >= floor[k]) & (score <= windows[k][1]))
                if len(at) > most:
                    at = at[np.lexsort((ids[at], -score[at]))[:most]]
                if len(at):
                    found[k] = heapq.nsmallest(most, found[k] + [
                        (-int(score[j]), int(ids[j])) for j in at])
                    if len(found[k]) == most:          # from here on, ties and larger ones
                        floor[k] = max(floor[k], -found[k][-1][0])
        return found, checked


# --- Spark ------------------------------------------------------------------------

_TREES = "tree long, width int, blob binary"


def _grown(table: pa.Table) -> pa.Table:
    """One tree per vector length of a hash bucket."""
    rows = table.column("vector").combine_chunks()
    widths = np.array(pc.list_value_length(rows).to_pylist(), np.int64)
    ids = np.array(table.column("vec_id").to_pylist(), np.int64)
    labels = np.array(table.column("label").to_pylist(), np.int64)
    out, bucket = [], table.column("tree")[0].as_py()
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        flat = rows.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        vectors = flat.astype(np.int64).reshape(len(at), int(width))
        out.append({"tree": bucket, "width": int(width),
                    "blob": Tree.build(ids[at], labels[at], vectors).dump()})
    return pa.Table.from_pylist(out, pa.schema([("tree", pa.int64()), ("width", pa.int32()),
                                                ("blob", pa.binary())]))


def candidates(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector of the rows that take part, one per id."""
    whole = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<double>").alias("vector")).where(
            "vec_id is not null and label is not null and vector is not null and forall(vector, "
            "x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return whole.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")) \
        .select("vec_id", "r.label", F.expr("transform(r.vector, x -> cast(x as long))")
                .alias("vector"))


def grow(rows: DataFrame, width: int, n: int) -> DataFrame:
    """The trees of ``n`` candidates with up to ``width`` components."""
    most = max(1, min(TREE_ROWS, TREE_BYTES // (8 * max(width, 1))))
    trees = max(1, -(-n // most))
    dealt = rows.withColumn("tree", F.pmod(F.xxhash64("vec_id"), F.lit(trees)))
    return staged(per_group(dealt, ["tree"], _grown, _TREES), "cover-trees")


def _answers(trees: DataFrame, asked: list[tuple], same: bool, most: int) -> DataFrame:
    """anchor_id, window (its number), vec_id, score: partial answers of every
    tree to ``asked`` (anchor_id, label, vector, windows)."""
    spark = trees.sparkSession
    sent = spark.sparkContext.broadcast(asked)
    schema = pa.schema([("anchor_id", pa.int64()), ("window", pa.int32()),
                        ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob"):
                tree, out = Tree.load(blob.as_py()), []
                for anchor_id, label, vector, windows in sent.value:
                    if len(vector) != tree.width:
                        continue
                    found, _ = tree.descend(anchor_id, vector, label, same, windows, most)
                    out += [(anchor_id, k, i, -s) for k, hits in enumerate(found)
                            for s, i in hits]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in
                     zip(zip(*out) if out else [()] * 4, schema)], schema=schema)

    found = staged(in_arrow(trees.select("blob"), run,
                            "anchor_id long, window int, vec_id long, score long"),
                   "tree-answers")
    sent.destroy()                                    # the answers are written
    best = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


_RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
           "negative_score long")


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100) -> DataFrame:
    """Per anchor (rows matching ``anchors``) and each of its first ``positives``
    rows of the same label, the first ``negatives`` rows of other labels whose
    score is from ``low`` to ``high`` percent of the positive's."""
    spark = rows.sparkSession
    known = staged(candidates(rows), "vectors")
    n, width = known.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    asking = known.where(anchors)
    n_asking = asking.count()
    result = spark.createDataFrame([], _RESULT)
    if not n_asking:
        return result
    trees = grow(known, width, n)
    blocks = -(-n_asking * (8 * width + 200) // BLOCK_BYTES)
    mine = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    for b in range(blocks):                           # about BLOCK_BYTES of anchors each
        block = [(r["vec_id"], r["label"], np.array(r["vector"], np.int64))
                 for r in asking.where(mine == b).collect()]
        if not block:
            continue
        first = _answers(trees, [(*a, [(-math.inf, math.inf)]) for a in block], True, positives)
        own: dict[int, list] = {}
        for r in first.orderBy("anchor_id", "rank").collect():   # at most positives per anchor
            own.setdefault(r["anchor_id"], []).append((r["vec_id"], r["score"]))
        asked = [(a, label, v, [(-(-low * s // 100), high * s // 100) for _, s in own[a]])
                 for a, label, v in block if a in own]
        second = _answers(trees, asked, False, negatives)
        pairs = spark.createDataFrame(
            [(a, k, i, s) for a, hits in own.items() for k, (i, s) in enumerate(hits)],
            "anchor_id long, window int, positive_id long, positive_score long")
        result = result.unionByName(second.join(pairs, ["anchor_id", "window"]).selectExpr(
            "anchor_id", "positive_id", "rank", "vec_id as negative_id", "positive_score",
            "score as negative_score"))
    return result
