"""Inversion: pairs to posting rows, block segments, and their merge.

Posting rows are flat. A list that has more than ``chunk_docs`` postings is cut
into chunks by document-id range, numbered from 1; any other list is chunk 0.
A range is wider where a list is sparse, so that the number of chunks follows that of
the postings and not that of the documents. Whatever works per (term_id, chunk) never
sees more rows in a group than ``widest_range(chunk_docs)``, and short lists stay in one
piece.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexipost.operators.dictionary import doc_term_pairs
from lexipost.operators.skew import join_weighted

CHUNK_DOCS = 1 << 16


def _doublings(chunk_docs: int) -> int:
    """How often a range of ``chunk_docs`` documents may double: up to 65,536 of them."""
    return max(0, (CHUNK_DOCS // chunk_docs).bit_length() - 1)


def widest_range(chunk_docs: int) -> int:
    """Documents in the widest range of a chunk; all narrower ones divide it."""
    return chunk_docs << _doublings(chunk_docs)


def range_docs(df: Column, chunk_docs: int, n_docs: int) -> Column:
    """Documents in each range of a list that has ``df`` of ``n_docs`` documents.

    The widest of the allowed ranges that hold ``chunk_docs`` postings at most if the list
    is spread evenly.
    """
    width = F.lit(chunk_docs)
    for k in range(1, _doublings(chunk_docs) + 1):
        width = F.when(df <= (n_docs >> k), F.lit(chunk_docs << k)).otherwise(width)
    return width


def chunk_of(df: Column, chunk_docs: int, n_docs: int = 0) -> Column:
    """The chunk of a row; without ``n_docs``, ranges are ``chunk_docs`` documents each."""
    place = F.call_function("div", F.col("doc_id"), range_docs(df, chunk_docs, n_docs)) + 1
    return F.when(df > chunk_docs, place).otherwise(F.lit(0)).cast("bigint")


def invert(
    forward: DataFrame,
    lexicon: DataFrame,
    chunk_docs: int = CHUNK_DOCS,
    keep: Sequence[str] = (),
    n_docs: int = 0,
) -> DataFrame:
    """Posting rows (block, term_id, chunk, doc_id) of a forward table.

    ``lexicon.df`` is the document frequency over ``forward``: it tells where lists are
    cut and which terms are heavy in the join. ``n_docs`` is the number of documents there.
    ``keep`` names columns of the lexicon that the rows take along.
    """
    pairs = doc_term_pairs(forward).select("doc_id", "block", "term")
    terms = lexicon.select("term", "term_id", "df", *[k for k in keep if k != "df"])
    return join_weighted(pairs, terms, "term", "df", whole=True).select(
        "block", "term_id", chunk_of(F.col("df"), chunk_docs, n_docs).alias("chunk"), "doc_id", *keep
    )


def block_segments(postings: DataFrame) -> DataFrame:
    """The inverted index of each block: (block, term_id, doc_id)."""
    return postings.select("block", "term_id", "doc_id")


def merge_segments(segments: Sequence[DataFrame], disjoint: bool = False) -> DataFrame:
    """One set of posting rows from several, under a shared dictionary.

    A document that two segments list for a term is kept once. Pass
    ``disjoint=True`` when no document is in two segments: the union is then the
    result and the shuffle of the dedup is saved.
    """
    rows = reduce(
        DataFrame.unionByName, [segment.select("term_id", "doc_id") for segment in segments]
    )
    return rows if disjoint else rows.dropDuplicates(["term_id", "doc_id"])


def document_frequency(postings: DataFrame) -> DataFrame:
    """(term_id, df): postings per term."""
    return postings.groupBy("term_id").agg(F.count("*").alias("df"))


def add_chunks(
    rows: DataFrame,
    lexicon: DataFrame,
    chunk_docs: int = CHUNK_DOCS,
    keep: Sequence[str] = (),
    n_docs: int = 0,
) -> DataFrame:
    """Chunk numbers for rows (term_id, doc_id), from the whole lists' (term_id, df).

    ``n_docs`` is the number of documents that the lists are spread over.
    ``keep`` names columns of ``lexicon``, which is read several times, to take along.
    """
    lists = lexicon.select("term_id", "df", *[k for k in keep if k != "df"])
    found = join_weighted(rows.select("term_id", "doc_id"), lists, "term_id", "df", whole=True)
    return found.select(
        "term_id", chunk_of(F.col("df"), chunk_docs, n_docs).alias("chunk"), "doc_id", *keep
    )


def posting_lists(postings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(term_id, chunk, doc_ids): ascending arrays, each at most a chunk long.

    ``keep`` names columns that have one value in a list, to take along.
    """
    return postings.groupBy("term_id", "chunk").agg(
        F.sort_array(F.collect_list("doc_id")).alias("doc_ids"),
        *[F.max(k).alias(k) for k in keep],
    )
