"""The training-corpus pipeline: five stages over ``documents``, each written and read again.

quality rules -> n-gram Jaccard join (one document of each group stays) -> benchmark
decontamination -> secret scans (secrets are replaced) -> packing into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.chosen_path import keep_one
from tickloom.llm.decontaminate import remove_contaminated
from tickloom.llm.frames import written
from tickloom.llm.packing import pack
from tickloom.llm.quality import keep_good
from tickloom.llm.queries import TOKENIZER
from tickloom.llm.secrets import redact


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest doc_id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, secrets replaced."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: No SQL: chosen paths, Markov models and tokens are beyond it; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
