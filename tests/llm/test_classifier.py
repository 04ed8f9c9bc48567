import random
import zlib
from math import exp, sqrt

import numpy as np
import pytest

from regcurate.llm import classifier


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = classifier.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 1000
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.97


def test_split_scores_and_edges(edge, labels):
    rows = classifier.classify(edge, labels).collect()
    assert len(rows) == edge.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    blank = {r.score for r in rows if r.doc_id in (4, 5, 6)}
    assert len(blank) == 1


def test_without_labels_and_empty(edge, empty, labels):
    assert {r.score for r in classifier.classify(edge, labels.limit(0)).collect()} == {0.5}
    assert classifier.classify(empty, labels).count() == 0


def test_held_out_labels_do_not_matter(documents, labels):
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")),
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    a = classifier.fit(documents, labels)
    assert (a == classifier.fit(documents, flipped)).all()


def plain_ftrl(examples, size, epochs):
    """Coordinate by coordinate, as published (McMahan et al., 2013)."""
    a, b, l1, l2 = classifier.ALPHA, classifier.BETA, classifier.L1, classifier.L2
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((b + sqrt(n[i])) / a + l2)

    for _ in range(epochs):
        for slots, values, y in examples:
            w = {i: weight(i) for i in slots}
            p = 1 / (1 + exp(-sum(w[i] * x for i, x in zip(slots, values))))
            for i, x in zip(slots, values):
                g = (p - y) * x
                sigma = (sqrt(n[i] + g * g) - sqrt(n[i])) / a
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return [weight(i) for i in range(size + 1)]


def test_updates_are_those_of_plain_ftrl():
    r = random.Random(2)
    examples = []
    for _ in range(60):
        slots = r.sample(range(16), r.randint(1, 9)) + [16]
        examples.append((slots, [r.random() for _ in slots], r.randint(0, 1)))
    got = classifier.train([(np.array(s), np.array(v), y) for s, v, y in examples], bits=4, epochs=3)
    assert got == pytest.approx(plain_ftrl(examples, 16, 3), abs=1e-5)


def test_repeated_rows_of_a_labelled_document_count_once(spark, documents, labels):
    few = documents.limit(50).cache()
    more = few
    for _ in range(3):
        more = more.unionByName(few)
    assert (classifier.fit(few, labels) == classifier.fit(more, labels)).all()
