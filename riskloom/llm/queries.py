"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from riskloom.llm import (bitslices, compress, cotrain, knn, lexical, lines, mixing, outliers, packing, paragraphs, pathjoin,
                          secrets, sharding)
from riskloom.llm.common import table

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op1_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cotrain.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.selectExpr("doc_id", "_p_text AS p_text", "_p_meta AS p_meta", "_score AS score", "_keep AS kept")


def op2_maglev_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), SHARDS).select("doc_id", "slot", "shard")


def op3_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.drop("d1", "d2")


def op6_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents"))


def op7_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pathjoin.join_documents(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "links")


def op8_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(table(spark, sf_dir, "documents")).drop("d1")


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(table(spark, sf_dir, "documents")).select("doc_id", "line", "component", "kept")


def op10_block_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.nearest(table(spark, sf_dir, "embeddings"))


def op11_limb_split_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress.compress(table(spark, sf_dir, "embeddings"))


def op12_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslices.top_products(table(spark, sf_dir, "embeddings"))


def op13_range_maximum_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_cotraining_quality": op1_cotraining_quality,
        "op2_maglev_shards": op2_maglev_shards,
        "op3_min_bin_slack": op3_min_bin_slack,
        "op4_blob_ledger_secrets": op4_blob_ledger_secrets,
        "op5_soft_mixing": op5_soft_mixing,
        "op6_robust_outliers": op6_robust_outliers,
        "op7_chosen_path_join": op7_chosen_path_join,
        "op8_paragraph_minhash": op8_paragraph_minhash,
        "op9_fuzzy_lines": op9_fuzzy_lines,
        "op10_block_knn": op10_block_knn,
        "op11_limb_split_codes": op11_limb_split_codes,
        "op12_bit_sliced_topk": op12_bit_sliced_topk,
        "op13_range_maximum_search": op13_range_maximum_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_blob_ledger_secrets": secrets.oracle(),
        "op11_limb_split_codes": compress.oracle(),
        "op12_bit_sliced_topk": bitslices.oracle(),
        "op13_range_maximum_search": lexical.oracle(),
    }
