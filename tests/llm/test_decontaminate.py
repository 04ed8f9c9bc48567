import random

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regcurate.llm import decontaminate as d


def _edited(text, edits, seed):
    r, out = random.Random(seed), list(text)
    for _ in range(edits):
        k = r.randrange(len(out))
        how = r.random()
        if how < 0.34:
            out[k] = r.choice("abcxyz")
        elif how < 0.67:
            del out[k]
        else:
            out.insert(k, r.choice("abcxyz"))
    return "".join(out)


@given(st.text("abc", min_size=1, max_size=20), st.text("abc", max_size=60), st.integers(0, 8))
@settings(max_examples=200, deadline=None)
def test_myers_distance(pattern, text, budget):
    bits = {}
    for i, c in enumerate(pattern):
        bits[c] = bits.get(c, 0) | 1 << i
    want = brute.substring_distance(pattern, text)
    got = d.myers(bits, len(pattern), text, budget)
    if want > budget or not text or len(pattern) <= budget and got is None:
        assert got is None or got[0] == want
    else:
        assert got[0] == want


@given(st.text("ab ", min_size=30, max_size=80), st.integers(0, 6), st.integers(0, 99))
@settings(max_examples=100, deadline=None)
def test_matcher_finds_all_within_budget(item, edits, seed):
    item = d.plain(item)
    if not item:
        return
    text = d.plain("zz " + _edited(item, min(edits, len(item) - 1), seed) + " yy")
    budget = int(len(item) * 0.1)
    want = brute.substring_distance(item, text)
    got = d.Matcher([(1, item)]).find(text)
    assert ([g[1] for g in got] == [want]) if want <= budget else got == []


@pytest.fixture(scope="module")
def planted(spark):
    r = random.Random(2)
    prose = lambda n: " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 8)))
                               for _ in range(n))
    items = [(i, prose(30)) for i in range(6)] + [(6, None), (7, "  "), (8, prose(30))]
    items.append((9, items[0][1]))                          # a repeated item
    docs = [(k, prose(80)) for k in range(30)]
    for k, i in ((3, 0), (7, 2), (11, 5)):
        words = docs[k][1].split()
        docs[k] = (k, " ".join(words[:40]) + "\n " + _edited(items[i][1], 4 * (k % 3), k).upper()
                   + " " + " ".join(words[40:]))
    docs += [(40, None), (41, ""), (42, items[1][1]), (42, items[1][1])]
    return (spark.createDataFrame(docs, "doc_id long, text string")
            .selectExpr("*", "'x' as item_id", "1 as distance"),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_planted_items(planted, block):
    docs, items = planted
    found = sorted((r.doc_id, r.item_id) for r in
                   d.matches(docs, items, block_chars=block).collect())
    assert found == [(3, 0), (3, 9), (7, 2), (11, 5), (42, 1), (42, 1)]
    kept = d.clean(docs, items, block_chars=block)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        set(range(30)) - {3, 7, 11} | {40, 41})


def test_empty(planted):
    docs, items = planted
    assert d.matches(docs, items.limit(0)).count() == 0
    assert d.clean(docs, items.limit(0)).count() == docs.count()
    assert d.matches(docs.limit(0), items).count() == 0


def test_benchmark_passages_in_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    texts, tests = docs.collect(), items.collect()
    exact = {(r.doc_id, t.item_id) for r in texts for t in tests
             if d.plain(t.text) in d.plain(r.text)}
    got = {(r.doc_id, r.item_id): r.distance for r in d.matches(docs, items).collect()}
    assert exact and exact <= {k for k, v in got.items() if v == 0}
    by_doc = {r.doc_id: d.plain(r.text) for r in texts}
    by_item = {t.item_id: d.plain(t.text) for t in tests}
    for (doc, item), v in list(got.items())[:5]:
        assert brute.substring_distance(by_item[item], by_doc[doc]) == v
