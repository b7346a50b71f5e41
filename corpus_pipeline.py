"""A pipeline over ``documents``: quality, rules, near-duplicates, secrets, packing.

Each stage gets the documents that its predecessor kept, written as Parquet and read
again, and its decisions take effect: rejected and duplicate documents leave, secrets
are blanked, the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plandrift.llm import common, packing, quality_classifier, quality_rules, secret_scan, simhash


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.keep_quality(docs, common.read(spark, sf_dir, "labels"))


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_by_rules(docs, common.read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("quality_rules", rules_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Stages 1, 3 and 5 (a trained model, connected components, a tokenizer) are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stage's rows being written before the next."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
