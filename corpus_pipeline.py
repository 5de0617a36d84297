"""Corpus cleaning pipeline over ``documents``: quality rules, exact copies, near copies, personal data, packing.

Each stage takes all documents that the one before it kept and returns the
columns of ``documents`` (the last one: the packed pieces). Stages are written
as Parquet and read again, so a lost executor costs no more than its stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.exact_dedup import drop_copies
from tessera.llm.packing import pack_documents
from tessera.llm.pii import sanitise
from tessera.llm.near_dedup import drop_near_copies
from tessera.llm.quality_rules import keep_good
from tessera.session import scratch_path, ship_package, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that a rule rejects go."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of equal texts the one with the largest id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each group of near copies the document with the smallest id stays."""
    return drop_near_copies(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: personal data and the terms that disclose it are generalised in the text."""
    return sanitise(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: what is left, packed into training sequences."""
    return pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("pii", pii),
          ("packing", packing)]

#: tokens and component search are beyond SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
