"""Gaps between the postings of a list, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexipost.functions.codes import VB_BASE
from lexipost.operators.skew import spread


def chunk_marks(postings: DataFrame) -> DataFrame:
    """For every chunk but the first of a long list, the last id of the one before.

    Only lists that were cut have rows here, one per chunk.
    """
    in_list = Window.partitionBy("term_id").orderBy("chunk")
    return (
        postings.filter("chunk > 0")
        .groupBy("term_id", "chunk")
        .agg(F.max("doc_id").alias("last"))
        .select("term_id", F.lead("chunk").over(in_list).alias("chunk"), F.col("last").alias("doc_id"))
        .filter("chunk is not null")
    )


def _checked_id() -> Column:
    doc_id, prev = F.col("doc_id"), F.col("prev")
    return F.when((doc_id >= 0) & (prev.isNull() | (prev < doc_id)), doc_id).otherwise(
        F.raise_error(F.lit("postings must be distinct and not negative")).cast("bigint")
    )


def previous_ids(postings: DataFrame, n_postings: int = 0) -> DataFrame:
    """Add ``prev``: the id before this one in its list, null for the first.

    The rows of a list must be distinct and not negative: a repeat would become a
    gap that no code can hold, so it fails the job. Each window holds one chunk. The id that a chunk starts from is put into it as
    a mark row ahead of its postings, so carrying it over takes no join. ``n_postings``, if
    known, tells how many tasks the windows by chunk that follow take.
    """
    rows = postings.select("term_id", "chunk", "doc_id", F.lit(False).alias("mark"))
    marks = chunk_marks(postings).select("term_id", "chunk", "doc_id", F.lit(True).alias("mark"))
    in_chunk = Window.partitionBy("term_id", "chunk").orderBy("doc_id")
    return (
        spread(rows.unionByName(marks), n_postings, "term_id", "chunk")
        .withColumn("prev", F.lag("doc_id").over(in_chunk))
        .filter(~F.col("mark"))
        .drop("mark")
        .withColumn("doc_id", _checked_id())
    )


def gaps(postings: DataFrame, base: int = VB_BASE, n_postings: int = 0) -> DataFrame:
    """(term_id, chunk, doc_id, prev, gap); the first gap of a list is from ``base``."""
    return (
        previous_ids(postings, n_postings)
        .withColumn("prev", F.coalesce("prev", F.lit(base).cast("bigint")))
        .withColumn("gap", F.col("doc_id") - F.col("prev"))
    )


def with_base(gapped: DataFrame) -> DataFrame:
    """Add ``base``: what the first gap of the chunk was measured from."""
    in_chunk = Window.partitionBy("term_id", "chunk")
    return gapped.withColumn("base", F.min("prev").over(in_chunk))


def gaps_to_postings(gapped: DataFrame, order: str = "pos") -> DataFrame:
    """Running sum of (term_id, chunk, base, ``order``, gap) rows within each chunk."""
    so_far = (
        Window.partitionBy("term_id", "chunk")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return gapped.select(
        "term_id", "chunk", (F.col("base") + F.sum("gap").over(so_far)).alias("doc_id")
    )
