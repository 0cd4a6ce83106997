"""The corpus pipeline: documents that a classifier and rules accept, one of each near-duplicate group, without personal data, packed.

Each stage takes the Parquet its predecessor wrote. All but the last give the columns of documents. Null ids and texts, repeated
rows, further columns with any names, and empty tables are fine; each stage says what becomes of them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import classifier, packing, pii, rules, simhash, store
from gristmill.llm.common import table
from gristmill.session import cut, shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. Null and empty texts are scored as texts without words, repeated rows alike."""
    return classifier.accepted(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. Null and empty texts go, as they have too few words; null ids can stay."""
    return rules.passing(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id, once if it is repeated. Null ids all stay."""
    return simhash.deduplicated(docs)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and n_chars of the new texts. Null texts stay null."""
    return pii.without_personal_data(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document with its place in a sequence of a permitted length. Null texts are an end id alone."""
    return packing.packed(store.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("pii", pii_redaction),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next. The folder goes when the result is kept."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark).rstrip('/')}/gristmill-pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    out = cut(docs)
    store.remove(spark, folder)
    return out


#: A classifier, trees and hashes of texts are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None
