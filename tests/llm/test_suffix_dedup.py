import hashlib
import random

import brute
import numpy as np
import pytest

from regcurate.llm import suffix_dedup


def _want(rows):
    texts = [r.text for r in rows]
    out = []
    for r, m in zip(rows, brute.repeated_mask(texts)):
        raw = np.frombuffer((r.text or "").encode(), np.uint8)
        runs = int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum())
        out.append((r.doc_id, len(raw), int(m.sum()), runs,
                    hashlib.sha256(raw[~m].tobytes()).hexdigest()))
    return sorted(out, key=str)


def _got(df, **kw):
    return sorted((tuple(r) for r in suffix_dedup.digests(df, **kw).collect()), key=str)


def test_documents_match_brute_force(documents):
    assert _got(documents) == _want(documents.collect())


def test_edges(edge, empty):
    assert _got(edge) == _want(edge.collect())
    assert _got(empty) == []


@pytest.fixture(scope="module")
def passages(spark):
    """Passages of 190 to 450 bytes and periodic stretches in many texts."""
    r = random.Random(11)
    word = lambda: "".join(r.choices("abcdeé", k=r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n)[:k] for n, k in ((40, 190), (60, 201), (60, 230), (90, 450))] + \
        ["ab" * 170, "x" * 260]
    rows = []
    for d in range(70):
        parts = [prose(r.randint(5, 60))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(shared)
            cut = r.randint(0, 40)
            parts += [p[cut:] if r.random() < 0.5 else p[:len(p) - cut], prose(r.randint(3, 30))]
        rows.append((d, " ".join(parts)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("parameters", [
    {}, {"contexts": 1}, {"contexts": 3}, {"hot": 2, "sample": 1}],
    ids=["refined", "all-split", "some-split", "hot"])
def test_shared_passages(passages, parameters):
    """The refinement, the split into windows and the hot path agree."""
    want = _want(passages.collect())
    assert sum(w[2] for w in want) > 5000
    assert _got(passages, **parameters) == want


def test_remove_repeats_keeps_columns_and_utf8(edge):
    rows = edge.collect()
    got = suffix_dedup.remove_repeats(edge)
    assert got.columns == edge.columns
    want = sorted(map(str, zip([r.doc_id for r in rows],
                               brute.without_repeats([r.text for r in rows]))))
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == want


def test_anchor_per_window_and_refinement():
    r = np.random.default_rng(1)
    for trial in range(6):
        text = r.integers(97, 99 if trial % 2 else 123, 2000).astype(np.uint8)
        a, b = r.integers(0, 1500, 2)
        text[b:b + 350] = text[a:a + 350].copy()
        ends = np.where(np.arange(2000) < 1200, 1200, 2000)
        raw = text.tobytes()
        windows = {}
        for i in range(2000):
            if i + 200 <= ends[i]:
                windows.setdefault(raw[i:i + 200], []).append(i)
        want = {i for v in windows.values() if len(v) > 1 for i in v}
        got = suffix_dedup.repeated_windows(text, ends)
        assert set(np.flatnonzero(got >= 0).tolist()) == want
    h = r.integers(0, 60, 700).astype(np.uint64)
    n = suffix_dedup.REACH + 1
    want = {p for i in range(len(h) - n + 1) for p in range(i, i + n) if h[p] == h[i:i + n].min()}
    assert set(suffix_dedup.anchors(h).tolist()) == want
