"""Corpus pipeline: quality rules, near-duplicate join, removal of repeated
passages, benchmark decontamination and packing, over ``documents``.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of ``documents``; the last one returns the pieces of the
packed sequences. ``run`` writes each stage's result as a table in the session's
shared folder and hands the reread table to the next.

Defined results: documents without text fail the base rules and go; of documents
linked as near duplicates the one with the least doc_id stays (one row of it); a
document loses repeated passages but stays, even if nothing is left; documents
with a benchmark item in them go.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regcurate.llm import decontaminate, jaccard, packing, quality_rules, suffix_dedup
from regcurate.llm.shared import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    judged = quality_rules.judge(docs, _table(spark, sf_dir, "labels"))
    return judged.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at similarity 0.8."""
    return jaccard.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that stand anywhere twice."""
    kept = suffix_dedup.remove_repeats(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) \
        if "n_chars" in docs.columns else kept


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, length=1024)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", leaks),
    ("packing", packed),
]

#: Packing, near-duplicate components and byte-level repeats have no SQL form;
#: tests/llm/test_pipeline.py compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of all documents of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
