"""The training-corpus pipeline: classify, remove near copies, decontaminate, pack.

``STAGES`` are (name, function) in order; a function takes (spark, docs,
sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``; the last returns packed pieces. ``run`` writes each stage as
Parquet into the session's shared stage folder and reads it back as the next
one's documents, so every stage works on all that its predecessor kept and a
lost executor costs no earlier stage.

Null texts, repeated rows, empty tables and extra columns are handled as the
operators say. Of repeated rows with the same id and text the second stage
keeps one; different texts with one id, or with none, are different documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaybook.llm import decontaminate, minhash, quality_qda
from quaybook.llm.queries import packed_digest, quality_model
from quaybook.plans.stages import write_stage
from quaybook.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant accepts. It is fitted on the
    labelled ones among ``docs``."""
    vectors = write_stage(quality_qda.vectors(docs), "vectors")
    return quality_qda.accepted(docs, quality_model(vectors, read_table(spark, sf_dir, "labels")))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.keep_one_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in cost-balanced sequences."""
    return packed_digest(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: SQL can't express the classifier, the sketches or the tokenizer; the tests
#: hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return docs
