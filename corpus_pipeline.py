"""The document pipeline: stages that each read what the one before kept.

Toxic documents go, one document of each group of near-duplicates stays, secrets in the
texts that are left are masked, documents are put in the order of the mixture of their
sources, and their texts are encoded.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexipost.llm import bpe, mixing, near_dedup, secrets, toxicity
from lexipost.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SECRET_MARK = "[secret]"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the model, fitted on the labels, does not find toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit_toxicity(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the least id, then the least text hash."""
    return near_dedup.without_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark and its length by the new one."""
    return secrets.redacted(docs, SECRET_MARK, length="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mixture; sources weigh the root of their text."""
    return mixing.mixed(docs, mixing.mix_sources(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, with digests of them and of what they decode to."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_decode(docs, vocabulary, with_decoded=False)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix),
    ("bpe", encode),
]
ORACLE_SQL = None  # a fitted model and a byte-pair vocabulary are not for SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
