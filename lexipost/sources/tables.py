"""Sources that are tables already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexipost import schemas


def documents_from_table(
    table: DataFrame, block: str | Column, name: str | Column, text: str | Column = "text"
) -> DataFrame:
    """Documents (block, name, text) from any table.

    (block, name) must identify a row, as a path identifies a file.
    """
    def text_column(source: str | Column) -> Column:
        return (F.col(source) if isinstance(source, str) else source).cast("string")

    return table.select(
        text_column(block).alias("block"),
        text_column(name).alias("name"),
        text_column(text).alias("text"),
    )


def read_documents(
    spark: SparkSession, path: str, block: str, name: str, text: str = "text"
) -> DataFrame:
    """Documents from a Parquet table; only the three columns are read."""
    return documents_from_table(spark.read.parquet(path), block, name, text)


def queries_from_rows(spark: SparkSession, rows: list[tuple[int, str]]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.QUERIES)
