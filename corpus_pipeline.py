"""Corpus pipeline: toxicity, near duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents its
predecessor kept; ``run`` writes each stage's result as Parquet under the
shared checkpoint folder and hands the reread table on, so a lost executor
never reaches back over a stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontam, ngram_join, packing, secret_scan, toxicity
from tidewatch.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on these documents' labels, does not reject."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents, the one with the smallest id."""
    return ngram_join.one_of_each_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_copies), ("benchmark_decontamination", drop_leaks),
          ("secret_scans", redact_secrets), ("best_fit_packing", pack)]

#: The classifier and the packing plan have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
