"""Readers of the tables in an index directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lexipost import schemas


def _with(schema: T.StructType, **more: T.DataType) -> T.StructType:
    return T.StructType(
        schema.fields + [T.StructField(name, kind) for name, kind in more.items()]
    )


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_with(schemas.DOCS, piece=T.LongType())).parquet(f"{path}/docs")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_with(schemas.LEXICON, first_doc=T.LongType())).parquet(
        f"{path}/lexicon"
    )


def read_posting_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_with(schemas.POSTINGS, shard=T.LongType())).parquet(
        f"{path}/postings"
    )


def read_encoded(spark: SparkSession, path: str) -> DataFrame:
    stored = [f for f in schemas.ENCODED.fields if f.name != "payload"]
    schema = _with(T.StructType(stored), payload=T.BinaryType(), shard=T.LongType())
    return spark.read.schema(schema).parquet(f"{path}/postings")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(term_id, doc_id, block); a filter on block reads that block's files only."""
    schema = T.StructType(
        [
            T.StructField("term_id", T.LongType()),
            T.StructField("doc_id", T.LongType()),
            T.StructField("block", T.StringType()),
        ]
    )
    return spark.read.schema(schema).parquet(path)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.META).json(f"{path}/meta")
