"""Packing tokenised documents into sequences: first-fit decreasing with a
tournament tree of bin capacities, in randomised groups of documents.

Each document is tokenised where it is read and cut into pieces of at most the
sequence length; only the pieces' numbers travel. Pieces are dealt to groups by
a hash, about ``GROUP_DOCS`` documents to a group, and each group is packed by
itself. The tree holds the largest free room below each node, so the first bin
with room is found in a walk from the root.

Defined results: a NULL or empty text is its end id alone; repeated rows are
packed one by one; an empty table gives no sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcurate.llm.shared import by_bytes, in_arrow, per_group
from regcurate.llm.tokens import tokenizer

#: Documents in a group, on average: many enough that full bins outweigh the
#: last ones, few enough for one task.
GROUP_DOCS = 4096


class Tournament:
    """Max-tree over the free room of bins; the winner of each node is the
    larger room below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """First bin with room for ``size``; its room shrinks."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return bin_


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) of each size; sizes run from 1 to capacity."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    full = int(np.count_nonzero(sizes == capacity))       # these fill a bin each
    bins[order[:full]], offsets[order[:full]] = np.arange(full), 0
    rest = order[full:]
    if len(rest):
        tree, used = Tournament(len(rest), capacity), [0] * len(rest)
        for i, size in zip(rest.tolist(), sizes[rest].tolist()):
            b = tree.place(size)
            bins[i], offsets[i] = full + b, used[b]
            used[b] += size
    return bins, offsets


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def pieces(docs: DataFrame, vocabulary: str, end_id: int, length: int) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(vocabulary)
        for batch in by_bytes(batches, "text", 4 << 20):
            ids, off = tok.encode(batch.column("text"))
            docs_, starts, sizes, sums, totals = [], [], [], [], []
            for d, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[off[d]:off[d + 1]], end_id).astype("<u4")
                for at in range(0, len(own), length):
                    part = own[at:at + length]
                    docs_.append(doc_id)
                    starts.append(at)
                    sizes.append(len(part))
                    sums.append(zlib.crc32(part.tobytes()))
                    totals.append(len(own))
            yield pa.RecordBatch.from_pydict(
                dict(zip(_PIECES.names, (docs_, starts, sizes, sums, totals))), schema=_PIECES)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return in_arrow(rows, run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def _pack_group(length: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])
        sizes = group["length"].to_numpy()
        bins, offsets = first_fit_decreasing(sizes, length)
        ids = (group["grp"].to_numpy().astype(np.int64) << 32) + bins
        return group.drop_columns(["grp"]).append_column("sequence_id", pa.array(ids)) \
            .append_column("offset", pa.array(offsets))
    return run


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, length: int = 1024,
         group_docs: int = GROUP_DOCS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of
    each piece; a sequence holds at most ``length`` ids."""
    groups = max(1, -(-docs.count() // group_docs))
    cut = pieces(docs, vocabulary, end_id, length).withColumn("grp", F.pmod(
        F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    return per_group(cut, ["grp"], _pack_group(length), "doc_id long, start long, length long, ids_crc32 long, "
                             "doc_tokens long, sequence_id long, offset long")
