"""The corpus pipeline: documents through five operators of harborline.llm, stage by stage.

Toxic documents go, then those that break a quality rule; one document of each group of near-duplicates stays; numbers
and dates that identify people become pseudonyms; what is left is packed into training sequences. Every stage reads all
that the stage before it kept, as a written table, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harborline.llm import near_duplicates, packing, pii, quality_rules, toxicity
from harborline.llm.common import documents, prepare, stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents scored toxic; the model learns from the labelled documents among those it is given."""
    prepare(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean_documents(docs, model)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that break a rule of the threshold table."""
    prepare(spark)
    return quality_rules.kept_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class, the one with the smallest doc_id."""
    prepare(spark)
    return near_duplicates.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal values by pseudonyms of the same format; the length of a text stays."""
    prepare(spark)
    return pii.pseudonymise(docs, pii.session_key(spark))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, the sequence each is in and the offset there."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality rules", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("personal data", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for at, (_, step) in enumerate(STAGES):
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{at}")
    return docs


# Trained scores, alignment and tokens are beyond SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None
