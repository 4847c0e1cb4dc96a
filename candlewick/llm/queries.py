"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from candlewick.llm import oracles
from candlewick.llm.common import read_table


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.embed_dedup import embedding_components

    return embedding_components(read_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.lm_score import lm_scores

    return lm_scores(read_table(spark, sf_dir, "documents"), modulus=7, held_out=2)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.token_count import token_counts

    return token_counts(read_table(spark, sf_dir, "documents"), vocabulary())


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), vocabulary(), window=1024)


def op5_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.topk import top_inner_products

    return top_inner_products(read_table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256.0)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.substring import dedup_substrings

    return dedup_substrings(read_table(spark, sf_dir, "documents"), window=20)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.pii import find_personal_data

    return find_personal_data(read_table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.simhash import simhash_components

    return simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, radius=3, seed=42)


def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.quality import quality_scores

    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), modulus=4, held_out=2, threshold=0.7)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.bpe import bpe_round_trip

    return bpe_round_trip(read_table(spark, sf_dir, "documents"), vocabulary())


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.merkle import tampered_check

    return tampered_check(read_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.align import align_tokens

    return align_tokens(read_table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


def op13_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candlewick.llm.permutation import nearest_neighbours

    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), k=10, every=100)


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_lm_scores": op2_lm_scores,
    "op3_token_counts": op3_token_counts,
    "op4_packing": op4_packing,
    "op5_top_inner_products": op5_top_inner_products,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_personal_data": op7_personal_data,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_quality_scores": op9_quality_scores,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_alignment": op12_token_alignment,
    "op13_approximate_neighbours": op13_approximate_neighbours,
    "pipeline": pipeline,
}

ORACLES = {
    "op1_embedding_near_dedup": oracles.EMBEDDING_NEAR_DEDUP,
    "op5_top_inner_products": oracles.TOP_INNER_PRODUCTS,
    "op6_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op11_merkle_manifest": oracles.MERKLE_MANIFEST,
}
