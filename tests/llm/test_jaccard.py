import random

import brute
import numpy as np
import pytest

from regcurate.llm import jaccard
from regcurate.llm.components import components


def _got(df, **kw):
    return sorted((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard.linked(df, **kw).collect())


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _got(docs) == brute.similar_components(rows)


def _family(seed, n, words=60):
    """Near copies of one text, some far enough apart to link in chains only."""
    r = random.Random(seed)
    base = [f"w{r.randint(0, 999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        base = list(base)
        base[r.randrange(words)] = f"x{r.randint(0, 9999)}"
        out.append(" ".join(base))
    return out


@pytest.fixture(scope="module")
def families(spark):
    texts = [t for s in range(12) for t in _family(s, 14)]
    common = " ".join(f"c{i}" for i in range(30))       # a passage many texts share
    texts += [common + " " + " ".join(f"u{k}_{i}" for i in range(k % 9)) for k in range(40)]
    random.Random(5).shuffle(texts)
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts


@pytest.mark.parametrize("rounds,hot", [(4, 200_000), (0, 200_000), (1, 2)])
def test_families_and_shared_passages(families, monkeypatch, rounds, hot):
    """With star rounds, without them, and with every shared shingle hot."""
    df, texts = families
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "HOT", hot)
    assert _got(df) == brute.similar_components(list(enumerate(texts)))


def test_prefixes_share_enough():
    """Every linked pair shares min(l) prefix shingles, whatever the l."""
    r = random.Random(3)
    texts = [t for s in range(6) for t in _family(s, 10, r.choice([20, 60, 300]))]
    sets = [np.array(sorted(hash(g) & (2 ** 63 - 1) for g in brute.shingles(t)), np.uint64)
            for t in texts]
    counts = np.zeros(jaccard.COUNTERS, np.uint64)
    for s in sets:
        np.add.at(counts, (s % jaccard.COUNTERS).astype(np.int64), 1)
    freq = jaccard.Frequencies(counts, np.unique(np.concatenate(sets))[:jaccard.LEAST])
    cut = [jaccard.prefix(s, freq, 80) for s in sets]
    assert len({l_ for _, l_ in cut}) > 1
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                met = len(np.intersect1d(cut[i][0], cut[j][0]))
                n, m = np.array([len(a)]), np.array([len(sets[j])])
                ask = jaccard.needed(n, m, np.array([cut[i][1]]), np.array([cut[j][1]]), 80)[0]
                assert met >= ask >= min(cut[i][1], cut[j][1])


@pytest.mark.parametrize("neighbours", [256, 2])
def test_met_postings_against_brute_force(monkeypatch, neighbours):
    monkeypatch.setattr(jaccard, "NEIGHBOURS", neighbours)
    r = np.random.default_rng(4)
    data = np.zeros(600, jaccard._RECORD)
    data["gram"], data["n"] = r.integers(0, 60, 600), r.integers(50, 200, 600)
    data["doc"], data["l"] = r.integers(0, 300, 600), r.integers(1, 9, 600)
    data["left"], data["hot"] = r.integers(1, 30, 600), r.integers(0, 20, 600) == 0
    got = {tuple(x) for x in jaccard.met_postings(data, 80)}
    for x in data:
        want = bool(x["hot"]) or any(
            int(jaccard.needed(*(np.array([int(v)]) for v in (x["n"], y["n"], x["l"], y["l"])),
                               80)[0]) <= min(x["left"], y["left"])
            for y in data if y["gram"] == x["gram"] and y["doc"] != x["doc"]
            and 100 * min(x["n"], y["n"]) >= 80 * max(x["n"], y["n"]))
        assert (tuple(x) in got) >= want
        assert neighbours == 2 or (tuple(x) in got) == want


def test_edges(edge, empty):
    got = {}
    for r in jaccard.linked(edge).collect():
        got.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    texts = {r.doc_id: r.text for r in edge.collect() if r.doc_id is not None}
    want = {d: {(n, c)} for d, n, c in brute.similar_components(sorted(texts.items()))}
    nulls = got.pop(None)
    assert got == want
    assert nulls == {(len(brute.shingles(texts[1])), None), (0, None)}
    assert jaccard.linked(edge).count() == edge.count()
    assert jaccard.linked(empty).count() == 0


def test_versions_of_one_document_are_linked(spark):
    a, b = _family(1, 1)[0], _family(2, 1)[0]
    df = spark.createDataFrame([(5, a), (5, b), (7, a), (3, b)], "doc_id long, text string")
    assert {r.component_id for r in jaccard.linked(df).collect()} == {3}


def test_one_of_each(edge, spark):
    kept = jaccard.one_of_each(edge)
    assert kept.columns == edge.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    texts = sorted({r.doc_id: r.text for r in edge.collect() if r.doc_id is not None}.items())
    assert ids == sorted({c for _, _, c in brute.similar_components(texts)})
    assert sum(r.doc_id is None for r in kept.collect()) == 2


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + \
        [(200, 201), (201, 202), (202, 200), (300, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    want = {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 130)} | {201: 200, 202: 200}
    assert got == want
    assert components(df.limit(0)).count() == 0
