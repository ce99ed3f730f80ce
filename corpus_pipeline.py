"""A training corpus from raw documents: five stages, each one operator.

Every stage reads what the stage before it wrote and returns the columns of
``documents``; the last returns packed sequences. Nulls, empty texts, repeated
rows, empty tables and extra columns are handled as each operator's docstring
says: documents without words are rejected by the first stage, extra columns
pass through all but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandlake.llm import secrets
from strandlake.llm.common import fresh_path
from strandlake.llm.decontaminate import decontaminate
from strandlake.llm.packing import pack
from strandlake.llm.quality import keep_good
from strandlake.llm.simhash import drop_near_duplicates


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label quality classifier keeps."""
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redact(docs, secrets.fit(secrets.labelled_findings(spark)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length, with their ids."""
    return pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Trained models, hashes and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
