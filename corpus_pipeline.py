"""The corpus pipeline: each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns what it keeps.

All stages but the last return the columns of ``documents``; ``run`` writes each stage's rows as Parquet to the shared folder and
reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payspark.llm import secrets, toxicity
from payspark.llm.common import ship
from payspark.llm.exact_dedup import drop_copies
from payspark.llm.near_dedup import drop_near_copies
from payspark.llm.packing import pack_documents
from payspark.session import work_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of severity grade 1 or more go; the model is learnt from the labelled rows among ``docs``."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    ship(spark)
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    ship(spark)
    return drop_near_copies(docs)


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    ship(spark)
    return secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placement of each document's token pieces in sequences of 4096 tokens."""
    ship(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("secret_scan", secret),
    ("best_fit_packing", packing),
]
#: Learnt, hashed and packed rows cannot be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
