import numpy as np
import pytest
from pyspark.sql import functions as F

from regcurate.llm import cover_tree
from regcurate.llm.cover_tree import Tree

SCHEMA = "vec_id long, label int, vector array<double>, score string, window int, blob string"


def _points(seed, n, d=6, spread=40):
    r = np.random.default_rng(seed)
    centres = r.integers(-200, 200, (4, d))
    return centres[r.integers(0, 4, n)] + r.integers(-spread, spread, (n, d))


def plain(rows, every, positives, negatives, low, high):
    """Every anchor against every row."""
    rows = [(i, label, np.array([int(c) for c in v], dtype=object)) for i, label, v in rows]
    out = []
    for i, label, v in rows:
        if i % every:
            continue
        all_scores = sorted((-int((v * w).sum()) if len(v) else 0, j, other)
                            for j, other, w in rows if j != i and len(w) == len(v))
        own = [(s, j) for s, j, other in all_scores if other == label][:positives]
        for p, j in own:
            hits = [(s, k) for s, k, other in all_scores if other != label
                    and low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(i, j, rank, k, -p, -s) for rank, (s, k) in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize("leaf", [1, 8, 64])
def test_tree_covers_nests_and_bounds(monkeypatch, leaf):
    monkeypatch.setattr(cover_tree, "LEAF", leaf)
    v = np.vstack([_points(1, 400), np.tile(_points(2, 1), (50, 1))])
    ids = np.arange(len(v))[::-1].copy()
    tree = Tree.load(Tree.build(ids, ids % 3, v).dump())
    assert sorted(tree.ids) == sorted(ids)
    top = (v.astype(float) ** 2).sum(1).max()
    x = np.column_stack([tree.points, np.sqrt(top - (tree.points ** 2).sum(1))])
    q = v[3].astype(float)
    for k in range(len(tree.centre)):
        members = slice(tree.begin[k], tree.end[k])
        far = np.linalg.norm(x[members] - x[tree.centre[k]], axis=1)
        assert far.max() <= tree.radius[k] + 1e-9
        low, high = tree.bounds(slice(k, k + 1), q, float(np.sqrt(q @ q)))
        score = tree.points[members] @ q
        assert low[0] <= score.min() and score.max() <= high[0]
        if tree.children[k]:
            kids = range(tree.child[k], tree.child[k] + tree.children[k])
            assert tree.centre[kids[0]] == tree.centre[k]            # nesting
            assert [tree.begin[c] for c in kids] + [tree.end[k]] == \
                [tree.begin[k]] + [tree.end[c] for c in kids]
            assert all(tree.radius[c] <= 2 * tree.radius[k] for c in kids)


def test_descent_skips_most_of_clustered_candidates(monkeypatch):
    monkeypatch.setattr(cover_tree, "LEAF", 16)
    v = _points(7, 4000, spread=12)
    ids, labels = np.arange(4000), np.zeros(4000, np.int64)
    tree = Tree.build(ids, labels, v)
    seen = [tree.descend(i, v[i], 0, True, [(-np.inf, np.inf)], 5)[1] for i in range(0, 4000, 200)]
    assert np.mean(seen) < 0.5 * 4000


@pytest.mark.parametrize("rows,block", [(16_384, 4 << 20), (40, 900)])
def test_equal_to_brute_force(spark, monkeypatch, rows, block):
    monkeypatch.setattr(cover_tree, "TREE_ROWS", rows)
    monkeypatch.setattr(cover_tree, "BLOCK_BYTES", block)
    monkeypatch.setattr(cover_tree, "LEAF", 8)
    v = _points(11, 260).tolist() + [[5.0] * 6] * 40                  # ties
    data = [(i, i % 4, [float(c) for c in x]) for i, x in enumerate(v)]
    data += [(300, 1, [1.0, 2.0]), (305, 1, [2.0, 2.0]), (306, 2, [2.0, 1.0]), (310, 1, []),
             (311, 1, []), (312, 2, [])]
    void = [(None, 1, [1.0] * 6), (400, None, [1.0] * 6), (410, 1, None), (420, 1, [1.0, None]),
            (430, 1, [float("nan")] * 6), (440, 1, [float("inf")] * 6)]
    df = spark.createDataFrame([(*r, "x", 1, "b") for r in data + void + data[:9]], SCHEMA)
    found = cover_tree.hard_negatives(df, F.col("vec_id") % 5 == 0, 3, 4, 80, 100)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.select(names).collect()) == \
        plain(data, 5, 3, 4, 80, 100)


def test_large_components(spark):
    data = [(i, i % 2, [float(1 << 28) + i, -3.0 * i, 7.0]) for i in range(30)]
    df = spark.createDataFrame([(*r, "x", 1, "b") for r in data], SCHEMA)
    found = cover_tree.hard_negatives(df, F.col("vec_id") % 10 == 0, 2, 2)
    assert sorted(tuple(r) for r in found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score",
        "negative_score").collect()) == plain(data, 10, 2, 2, 80, 100)


def test_no_anchor_and_empty_table(spark):
    df = spark.createDataFrame([(1, 1, [1.0], "x", 1, "b")], SCHEMA)
    assert cover_tree.hard_negatives(df, F.col("vec_id") % 10 == 0).collect() == []
    assert cover_tree.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert cover_tree.hard_negatives(df, F.col("vec_id") == 1).collect() == []
