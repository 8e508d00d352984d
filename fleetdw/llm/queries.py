"""The registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.llm import (ann, bpe, embed_dedup, line_dedup, merkle, mixing, periodic, pii, secret_scan, sharding, simhash,
                         token_files, toxicity)

BYTE_RANKS = "byte_bpe_50k.tiktoken"
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_token_files_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), end_id=2)


def op3_sharding_extendible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_read(spark, sf_dir, "documents"), limit=sharding.LIMIT)


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.98)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find(_read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS),
                            public_tokenizers.PATTERN).drop("found")


def op6_mixing_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"), share=1.5, max_copies=2)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents")).drop("text_hash", "hits")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op10_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op11_line_dedup_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_common(_read(spark, sf_dir, "documents"), least=10, shortest=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_merkle_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.scan(_read(spark, sf_dir, "documents"))


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_toxicity_bigru, op2_token_files_repair, op3_sharding_extendible, op4_embedding_near_dedup,
                                    op5_secret_scan, op6_mixing_flow, op7_nearest_neighbours,
                                    op8_pii_boosting, op9_simhash_near_dedup, op10_bpe_encode_decode, op11_line_dedup_runs,
                                    op12_merkle_witnesses, op13_periodic_runs)}
