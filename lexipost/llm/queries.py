"""The queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexipost.llm import (
    bpe,
    merkle,
    mixing,
    near_dedup,
    order_minhash,
    pii,
    product_codes,
    quality,
    secrets,
    token_files,
    toxicity,
    url_filter,
    vector_dedup,
)
from lexipost.session import new_stage_path

Query = Callable[[SparkSession, str], DataFrame]

END_ID = 2
PSEUDONYM_SECRET = "a secret of the query, not of anyone"
#: The rules of the URL query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_stage_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(docs, path, vocabulary, END_ID)
    return token_files.token_offsets(spark, path)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        with_ids=False,
        with_decoded=False,
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def written(spans: str) -> str:
        return (
            f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
        )

    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = "filter(spans, s -> s.kind IN ('assign', 'access', 'hex'))"
    return found.select(
        "doc_id",
        *[
            F.expr(f"cast(size(filter(spans, s -> s.kind = '{rule.kind}')) as bigint)").alias(
                f"n_{rule.kind}"
            )
            for rule in secrets.BASE_RULES
        ],
        F.expr(f"sha2({written(base)}, 256)").alias("base_sha256"),
        F.expr(written("spans")).alias("spans"),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymized(table(spark, sf_dir, "documents"), PSEUDONYM_SECRET)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source weighs the square root of its text."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.vector_duplicates(table(spark, sf_dir, "embeddings"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of every other document, by checksum of the id, lose their line ends."""
    claimed = {"text": merkle.without_line_ends()}
    return merkle.verify_rows(table(spark, sf_dir, "documents"), claimed)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ).drop("failed_rules")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_codes.compress_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_token_files": op2_token_files,
    "op3_toxicity": op3_toxicity,
    "op4_bpe": op4_bpe,
    "op5_secrets": op5_secrets,
    "op6_url_filter": op6_url_filter,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_fingerprints": op8_fingerprints,
    "op9_mixing": op9_mixing,
    "op10_vector_dedup": op10_vector_dedup,
    "op11_merkle": op11_merkle,
    "op12_quality": op12_quality,
    "op13_vector_codes": op13_vector_codes,
}
