"""Result files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_results(results: DataFrame, path: str, queries: DataFrame | None = None) -> None:
    """One directory ``qid=<qid>`` per query, one path per line.

    Lines are in doc_id order within a file and over the files of a directory in
    name order; a query with many results is cut over several files. With ``queries``,
    the batch that was asked, a query without results gets a file of one empty line.
    """
    order = ["qid", "doc_id"]
    rows = results.select("qid", "doc_id", "path")
    if queries is not None:
        silent = queries.select("qid").distinct().join(rows, "qid", "left_anti")
        rows = rows.unionByName(
            silent.select("qid", F.lit(None).cast("bigint").alias("doc_id"), F.lit("").alias("path"))
        )
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("qid", "path")
        .write.mode("overwrite")
        .partitionBy("qid")
        .text(path)
    )
