"""Registered queries of the training-data operators. Each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_cnn

    return quality_cnn.classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing

    return packing.packed_documents(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jaccard_join

    return jaccard_join.similarity_classes(_table(spark, sf_dir, "documents"))


def op4_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import fingerprints

    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op5_warc_record_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc

    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op6_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate

    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import sharding

    return sharding.sharded(_table(spark, sf_dir, "documents"))


def op8_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import license_scan

    return license_scan.scanned(_table(spark, sf_dir, "documents"))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    return pii.report(_table(spark, sf_dir, "documents"))


def op10_simple8b_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_files

    return token_files.token_files(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import merkle

    return merkle.audited(_table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import divergence

    return divergence.audited(_table(spark, sf_dir, "documents"))


def op13_simhash_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash_trie

    return simhash_trie.near_duplicates(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from . import oracle

    return dict(oracle.ORACLE)
