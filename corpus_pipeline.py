"""Documents to a training mix: five stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tieproof.llm import decontaminate, mixture, near_copies, quality, secrets
from tieproof.llm.tables import saved, table

#: No SQL can say what the trees, the retrieval and the mix decide; tests compare with brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees score 0.7 or more; the trees learn from the labels of the folder."""
    return quality.keep_good(docs, quality.fit(docs, quality.training_labels(spark, sf_dir)), 0.7)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: that with the smallest id."""
    return near_copies.keep_one(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.mask_secrets(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix with the words that it takes of each, repeats counted."""
    return mixture.mixed_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_each),
    ("decontamination", without_leaks),
    ("secrets", without_secrets),
    ("mixture", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
