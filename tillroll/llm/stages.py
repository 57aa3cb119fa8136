"""Stages of the corpus pipeline: each calls one operator and lets its decisions take effect on the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    from . import quality_cnn

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_cnn.accepted(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    from . import jaccard_join

    return jaccard_join.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    from . import decontaminate

    return decontaminate.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    from . import pii as operator

    return operator.replaced(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in packed sequences."""
    from . import packing as operator

    return operator.packed_documents(docs)
