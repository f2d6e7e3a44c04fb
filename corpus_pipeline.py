"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Every stage works on all documents that the one before it kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadlens.llm import decontaminate, mixing, secrets, shingle_join, toxicity
from loadlens.llm.tables import store, table
from loadlens.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the classifier rejects go."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of near-duplicates the document with the least id stays."""
    ship_package(spark)
    return shingle_join.keep_one(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a copy of a benchmark item go."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: all documents stay; every reported secret becomes a mark, and n_chars is renewed."""
    ship_package(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: every document gets its place in the mix of sources."""
    ship_package(spark)
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("secret_scans", redact_secrets),
    ("mixing_sources", mix_sources),
]

#: Classifiers, set joins, alignments and compression aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
