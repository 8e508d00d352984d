"""A training-corpus pipeline over ``documents``: five stages, each one operator.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; ``run`` writes each result to the shared folder as Parquet
and reads it again as the next stage's input. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.llm import bpe, mixing, pii, simhash, toxicity
from fleetdw.llm.common import materialise


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores at 0.5 or more go. It learns from the labelled
    documents of the stage's input that are not held out."""
    net = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, net)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id
    (of rows that repeat it, the smallest of all columns). Groups are components of texts,
    not ids: documents without an id are grouped by their texts, the last to be chosen, and
    unrelated texts under one id each stay."""
    return simhash.representatives(docs, shingle=3, max_bits=3)


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by the name of its kind; n_chars follows."""
    out = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once, twice or not at all, so that sources near their target words."""
    return mixing.mixed(docs, share=1.5, max_copies=2)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", reject_toxic), ("simhash_near_dedup", near_dedup), ("pii", redact_private),
          ("mixing", mix_sources), ("bpe", encode)]

#: SQL can express neither the model, the XXH64 fingerprints nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
