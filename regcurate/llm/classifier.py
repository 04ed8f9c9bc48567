"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates, scored as sparse dot products.

Features of a text are its words, word pairs, word shapes (class of first and
last character, length) with triples of them, and pairs of "same word as the one
before", hashed into 2**BITS slots; a slot's value is its share of the text's
n-grams. The model is one array of weights, fixed in
size, that every task receives.

The model is fitted on at most ``MAX_TRAIN`` labelled documents (those with the
lowest hash of doc_id): the selection joins by doc_id, features are computed
where the documents lie, and one task runs the updates, which are sequential by
nature. Scoring reads every whole text.

Defined results: a NULL or empty text has the bias alone; a doc_id labelled
more than once takes its highest label, NULL labels are void; of several rows of a
doc_id the least text is learnt from, once; without labels all scores are 0.5;
repeated rows are scored one by one; a NULL doc_id is not held out; texts of any
length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regcurate.llm.shared import (by_bytes, in_arrow, ngram_hashes, per_group, prefix_hash,
                                  range_hash, utf8, word_spans)

BITS = 18
MAX_TRAIN = 8_000
EPOCHS = 3
#: Per-coordinate FTRL: learning rate, smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.0005, 0.0001


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the doc_id's text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


_CLASS = np.zeros(256, np.uint64)
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[128:] = 4
for _n, _c in enumerate(b"!#$%&*.,;:|<>()-'\"?=+/@_"):
    _CLASS[_c] = 5 + _n


def text_slots(raw: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(slots of all texts' n-grams, offsets per text)."""
    starts, ends, first = word_spans(raw, off)
    words = range_hash(prefix_hash(raw), starts, ends)
    shapes = (_CLASS[raw[starts]] << np.uint64(12)) + (_CLASS[raw[ends - 1]] << np.uint64(6)) \
        + np.minimum(ends - starts, 15).astype(np.uint64) if len(starts) else words
    again = np.zeros(len(words), np.uint64)       # the word before was the same
    again[1:] = words[1:] == words[:-1]
    mask = np.uint64((1 << bits) - 1)
    kinds = []
    for values, n, salt in ((words, 1, 1), (words, 2, 2), (shapes, 1, 3), (shapes, 3, 4),
                            (again, 2, 5)):
        slots = ngram_hashes(values + np.uint64(salt << 56), n) >> np.uint64(7)
        inside = np.ones(len(slots), bool)
        for k in range(1, n):                     # n-grams across two texts are none
            edge = first[1:-1] - k
            inside[edge[(edge >= 0) & (edge < len(slots))]] = False
        owner = np.searchsorted(first, np.flatnonzero(inside), side="right") - 1
        kinds.append((owner, (slots[inside] & mask).astype(np.int64)))
    owner = np.concatenate([o for o, _ in kinds])
    order = np.argsort(owner, kind="stable")
    offsets = np.searchsorted(owner[order], np.arange(len(off)))
    return np.concatenate([s for _, s in kinds])[order], offsets


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS,
          epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the bias) from (slots, values, label) by
    per-coordinate FTRL-proximal updates, in the given order."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(epochs):
        for slots, values, label in examples:
            w = weights(slots)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            sigma = (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / ALPHA
            z[slots] += g - sigma * w
            n[slots] += g * g
    return weights(np.arange(size + 1)).astype("<f4")


#: Shares of n-grams are small; scaled so that the bias does not outrun them.
SCALE = 30.0


def _example(slots: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    at, counts = np.unique(slots, return_counts=True)
    return (np.append(at, 1 << bits),
            np.append(counts * (SCALE / max(1, len(slots))), 1.0))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN,
        bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights learnt from labelled documents that are not held out."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
              .where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    # at most max_train short rows; one text of each is learnt from
    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            slots, off = text_slots(*utf8(batch.column("text")), bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("y"),
                 pa.array([slots[a:b].astype("<i4").tobytes() for a, b in zip(off[:-1], off[1:])],
                          pa.binary())], names=["doc_id", "y", "slots"])

    def learn(table: pa.Table) -> pa.Table:
        order = np.argsort([(r * 0x9E3779B1) % (1 << 32) for r in table["doc_id"].to_pylist()],
                           kind="stable")
        rows = [(np.frombuffer(s, "<i4"), y) for s, y in zip(table["slots"].to_pylist(),
                                                             table["y"].to_pylist())]
        model = train([(*_example(rows[i][0], bits), rows[i][1]) for i in order], bits, epochs)
        return pa.table({"model": pa.array([model.tobytes()], pa.binary())})

    sample = in_arrow(rows, features, "doc_id long, y int, slots binary")
    found = per_group(sample.withColumn("all", F.lit(0)), ["all"], learn, "model binary").collect()
    return np.frombuffer(found[0]["model"], "<f4") if found else \
        np.zeros((1 << bits) + 1, "<f4")


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """doc_id and score (probability of label 1) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value.astype(np.float64)
        for batch in by_bytes(batches, "text"):
            slots, off = text_slots(*utf8(batch.column("text")), bits)
            total = np.concatenate([[0.0], np.cumsum(w[slots])])
            n = np.maximum(1, off[1:] - off[:-1])
            dots = w[-1] + (total[off[1:]] - total[off[:-1]]) * SCALE / n
            p = 1 / (1 + np.exp(-np.clip(dots, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(p)], names=["doc_id", "score"])

    return in_arrow(docs.select("doc_id", F.col("text").cast("string")), run,
                    "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = score(docs, fit(docs, labels, label))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
