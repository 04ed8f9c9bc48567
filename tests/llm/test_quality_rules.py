from math import comb

import brute
import pytest
from pyspark.sql import functions as F

from regcurate.llm import quality_rules as q


def _judged(docs, labels, **kw):
    cols = ["row.doc_id", "f.*", "base_failed", "kept"]
    return q.judge(docs, labels, keep=["doc_id"], **kw).select(*cols)


def test_base_counts_match_brute_force(edge, labels):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in _judged(edge, labels).collect()}
    want = {(r.doc_id, *brute.base_counts(r.text)) for r in edge.collect()}
    assert got == want


def test_base_counts_of_documents(documents, labels):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                      r.base_failed) for r in _judged(documents, labels).collect()}
    for r in documents.collect():
        c = brute.base_counts(r.text)
        assert got[r.doc_id] == (*c, c[0] < 50 or 100 * c[4] > 50 * c[0])


def test_nothing_but_base_rules_without_evidence(edge, labels):
    judged = _judged(edge, labels.limit(0))
    assert judged.where("kept = base_failed").count() == 0
    assert judged.count() == edge.count()


@pytest.mark.parametrize("k,n,p", [(0, 40, 0.1), (3, 100, 0.05), (7, 1000, 0.01), (50, 100, 0.05)])
def test_binomial_cdf(spark, k, n, p):
    got = spark.range(1).select(q.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p)) \
        .first()[0]
    want = sum(comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k + 1)) if k < n * p else 1.0
    assert got == pytest.approx(want, rel=1e-9)


def plain_kept(docs, labels, rules=q.RULES, risk=q.RISK, delta=q.DELTA):
    """doc_id -> verdicts of its rows, one rule and setting after the other."""
    good = {}
    for d, quality in labels:
        good[d] = max(good.get(d, 0), quality or 0)
    rows, settings = [], len(rules[0].cutoffs)
    for d, text, stratum in docs:
        words, chars, symbols, lines, repeats = brute.base_counts(text)
        value = {"symbols": symbols, "long_words": chars, "short_words": chars,
                 "dup_lines": 100 * lines, "repeats": repeats}
        failed = words < 50 or 100 * repeats > 50 * words
        hit = [s for s in range(settings) for r in rules if words and (
            (value[r.name] / words > r.cutoffs[s]) if r.above
            else (value[r.name] / words < r.cutoffs[s]))]
        rows.append((d, stratum, failed, min(hit, default=settings)))
    strata, chosen = {}, {}
    for d, stratum, failed, hit in rows:
        if not failed and good.get(d) == 1:
            trials = strata.setdefault(stratum, {})
            trials[d] = min(trials.get(d, settings), hit)
    for stratum, trials in strata.items():
        n, chosen[stratum] = len(trials), 0
        for s in range(settings):
            k = sum(hit <= s for hit in trials.values())
            p = sum(comb(n, j) * risk ** j * (1 - risk) ** (n - j) for j in range(k + 1))
            if k >= n * risk or p > delta / len(strata):
                break
            chosen[stratum] = s + 1
    out = {}
    for d, stratum, failed, hit in rows:
        out.setdefault(d, []).append(not failed and hit >= chosen.get(stratum, 0))
    return {d: sorted(v) for d, v in out.items()}, chosen


def _kept(docs, labels):
    out = {}
    for r in _judged(docs, labels).collect():
        out.setdefault(r.doc_id, []).append(r.kept)
    return {d: sorted(v) for d, v in out.items()}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_settings_over_documents(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf{sf}/{t}.parquet")
                    for t in ("documents", "labels"))
    want, chosen = plain_kept([(r.doc_id, r.text, r.lang) for r in docs.collect()],
                              [(r.doc_id, r.quality) for r in labels.collect()])
    assert _kept(docs, labels) == want
    if sf == "0.01":                       # the largest stratum has evidence enough
        assert chosen["en"] > 0
        assert _judged(docs, labels).where("not base_failed and not kept").count() > 0


def test_rules_together_limit_false_rejections(spark):
    """Each rule alone is within the risk, all together are not: the path stops."""
    good = " ".join(f"word{i}" for i in range(100))
    def text(i):
        if i < 30:
            return good + " #" * 60                    # symbols, from setting 2
        if i < 60:
            return good + "\nx y\nx y\nx y\nx y"        # repeated lines, from setting 4
        return good
    rows = [(i, text(i), "en") for i in range(1000)]
    rows += [(5000 + i, good + " #" * 60, "en") for i in range(50)]
    rows += [(9000 + i, good, "xx") for i in range(60)] * 4            # repeats prove nothing
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = [(i, 1) for i in range(1000)] + [(5000 + i, 0) for i in range(50)]
    labels += [(9000 + i, 1) for i in range(60)]
    want, chosen = plain_kept(rows, labels)
    assert 0 < chosen["en"] < 6 and chosen["xx"] == 0
    got = _kept(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert got == want
    assert sum(not got[i][0] for i in range(1000)) <= 50
    assert not any(v for i in range(50) for v in got[5000 + i])


def test_empty_table(empty, labels):
    assert _judged(empty, labels).count() == 0
