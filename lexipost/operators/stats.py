"""Sizes and positions of postings lists, without encoding them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexipost.functions import codes
from lexipost.functions.numbers import whole_div
from lexipost.operators.gaps import previous_ids
from lexipost.operators.ranking import PIECE_ROWS, exclusive_totals


def list_sizes(postings: DataFrame, rows: int = 0) -> DataFrame:
    """(term_id, n_postings, raw, vb, gamma): bytes of each whole list per codec.

    ``rows``, if known, is the number of postings.
    """
    doc, prev = F.col("doc_id"), F.col("prev")
    vb_gap = doc - F.coalesce(prev, F.lit(codes.VB_BASE))
    gamma_gap = doc - F.coalesce(prev, F.lit(codes.GAMMA_BASE))
    return (
        previous_ids(postings, rows)
        .groupBy("term_id")
        .agg(
            F.count("*").alias("n_postings"),
            F.sum(codes.vb_bytes(vb_gap)).alias("vb"),
            F.sum(codes.gamma_bits(gamma_gap)).alias("bits"),
        )
        .select(
            "term_id",
            "n_postings",
            (F.col("n_postings") * codes.RAW_BYTES).alias("raw"),
            "vb",
            whole_div(F.col("bits") + 7, 8).alias("gamma"),
        )
    )


def term_stats(postings: DataFrame, piece: int = PIECE_ROWS, rows: int = 0) -> DataFrame:
    """(codec, term_id, start_pos, n_postings, n_bytes), lists laid out by term id.

    One pass over the postings serves the three codecs.
    """
    placed = exclusive_totals(
        list_sizes(postings, rows), "term_id", {c: f"{c}_start" for c in codes.CODECS}, piece
    )
    entries = [
        F.struct(
            F.lit(c).alias("codec"),
            F.col(f"{c}_start").alias("start_pos"),
            F.col(c).alias("n_bytes"),
        )
        for c in codes.CODECS
    ]
    return placed.select(
        "term_id", "n_postings", F.explode(F.array(*entries)).alias("entry")
    ).select("entry.codec", "term_id", "entry.start_pos", "n_postings", "entry.n_bytes")


def size_report(postings: DataFrame, rows: int = 0) -> DataFrame:
    """(codec, n_terms, n_postings, n_bytes) of the whole index."""
    totals = list_sizes(postings, rows).agg(
        F.count("*").alias("n_terms"),
        F.coalesce(F.sum("n_postings"), F.lit(0)).alias("n_postings"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in codes.CODECS],
    )
    entries = [F.struct(F.lit(c).alias("codec"), F.col(c).alias("n_bytes")) for c in codes.CODECS]
    return totals.select(
        "n_terms", "n_postings", F.explode(F.array(*entries)).alias("entry")
    ).select("entry.codec", "n_terms", "n_postings", "entry.n_bytes")
