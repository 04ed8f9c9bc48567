"""Every stage of the pipeline against a brute-force version, and the whole."""

import brute
import pytest

import corpus_pipeline
from test_quality_rules import plain_kept
from regcurate.llm import decontaminate

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from regcurate.llm.shared import staged

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "test-stage")
        out.append(docs.collect())
    return out


def _quality_keeps(rows, sf, spark):
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    kept, _ = plain_kept([(r.doc_id, r.text, r.lang) for r in rows], labels)
    return {d for d, verdicts in kept.items() if any(verdicts)}


def test_quality_with_cutoffs_in_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    after = corpus_pipeline.quality(spark, docs, sf)
    assert {r.doc_id for r in after.select("doc_id").collect()} == \
        _quality_keeps(docs.collect(), sf, spark)


def test_quality(spark, stages):
    before, after = stages[0], stages[1]
    want = _quality_keeps(before, SF, spark)
    assert {r.doc_id for r in after} == want
    by_id = {r.doc_id: r for r in before}
    assert all(by_id[r.doc_id] == r for r in after)


def test_near_duplicates(stages):
    before, after = stages[1], stages[2]
    want = {c for _, _, c in brute.similar_components([(r.doc_id, r.text) for r in before])}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_repeats(stages):
    before, after = stages[2], {r.doc_id: r for r in stages[3]}
    texts = brute.without_repeats([r.text for r in before])
    assert len(after) == len(before)
    for r, text in zip(before, texts):
        got = after[r.doc_id]
        assert (got.text, got.n_chars, got.source) == (text, len(text), r.source)


def test_leaks(spark, stages):
    before, after = stages[3], stages[4]
    items = [decontaminate.plain(r.text) for r in
             spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    exact = {r.doc_id for r in before if any(i in decontaminate.plain(r.text) for i in items)}
    assert exact <= gone
    for r in before:
        if r.doc_id in gone:
            assert any(brute.substring_distance(i, decontaminate.plain(r.text)) <= len(i) // 10
                       for i in items)


def test_packing_keeps_every_document(stages):
    before, after = stages[4], stages[5]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    for r in before:
        own = sorted((p.start, p.length) for p in after if p.doc_id == r.doc_id)
        assert sum(n for _, n in own) == next(p.doc_tokens for p in after if p.doc_id == r.doc_id)


def test_run_and_columns(spark, stages):
    got = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, got)) == sorted(map(key, stages[-1]))


def test_edges_pass_through(spark, edge, empty):
    for docs in (edge, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stage(spark, docs, SF)
            assert docs.columns == columns
            docs = docs.cache()
        docs.count()
