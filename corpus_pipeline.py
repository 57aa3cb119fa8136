"""Training-data pipeline over the `documents` table: each stage is a (name, function) pair, is written as Parquet and is
reread as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import stages as S
from tillroll.llm.common import written

STAGES = [
    ("quality_classifier", S.quality),
    ("ngram_jaccard_join", S.near_duplicates),
    ("benchmark_decontamination", S.decontamination),
    ("pii_surrogates", S.pii),
    ("best_fit_packing", S.packing),
]

#: Scores of a trained network, MinHash and a tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole `documents` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
