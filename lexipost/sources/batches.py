"""Query batches and expected results kept as small text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexipost.functions.text import normal_path
from lexipost.sources.folder import list_files, read_files

# The file names of a batch.
QUERY_FILE = r"^query\.([0-9]+)$"
RESULT_FILE = r"^([0-9]+)\.out$"


def _whole_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(qid, value) of every file of the batch; an empty file has an empty value.

    One task lists the folder; the files whose names fit are then read, each once.
    """
    here = spark.range(0, 1, 1, 1).select(F.lit("").alias("block"))
    listed = list_files(folder, here).filter(F.col("name").rlike(pattern))
    return read_files(spark, folder, listed).select(
        F.regexp_extract("name", pattern, 1).cast("bigint").alias("qid"),
        F.col("content").cast("string").alias("value"),
    )


def read_queries(spark: SparkSession, folder: str) -> DataFrame:
    """(qid, query) from the files ``query.<qid>``, one query in each."""
    return _whole_files(spark, folder, QUERY_FILE).select("qid", F.col("value").alias("query"))


def _lines(value: Column) -> Column:
    """The lines of a file; the end of the last line does not start another."""
    lines = F.split(F.regexp_replace(value, r"\n\z", ""), "\n")
    return F.when(value == "", F.array().cast("array<string>")).otherwise(lines)


def read_expected(spark: SparkSession, folder: str) -> DataFrame:
    """(qid, rank, path) from the files ``<qid>.out``, one path on each line."""
    return (
        _whole_files(spark, folder, RESULT_FILE)
        .select("qid", F.posexplode(_lines(F.col("value"))).alias("rank", "line"))
        .select(
            "qid",
            F.col("rank").cast("bigint").alias("rank"),
            normal_path(F.regexp_replace("line", r"^\s+|\s+$", "")).alias("path"),
        )
    )
