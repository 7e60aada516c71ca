"""Where postings go: file partitions from running totals of the document frequencies.

The lexicon says how long each list is, so the place of a list among all postings is a
running total, and the place divided by the size of a partition is its partition. Nothing
has to be sampled or written twice to range-partition the postings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexipost.functions.numbers import whole_div
from lexipost.operators.skew import few_keys, join_weighted
from lexipost.session import stage

_MOST_ROWS = 4_000_000  # postings of a partition, about
_LEAST_ROWS = 1 << 16
_MOST_PIECES = 1 << 18


def shard_of(term_id: Column, n_shards: int) -> Column:
    return F.pmod(term_id, F.lit(n_shards)).cast("bigint")


@dataclass(frozen=True)
class Layout:
    """Partitions of ``rows`` postings each, in the order of (shard, term, document)."""

    n_shards: int
    n_docs: int
    n_postings: int
    chunk_docs: int
    rows: int

    @property
    def n_parts(self) -> int:
        return max(1, -(-self.n_postings // self.rows))

    def part(self, df: Column, start: Column, doc_id: Column) -> Column:
        """The partition of a posting of a list that starts at place ``start``.

        A list that is longer than a partition goes on in the next ones. It is cut at
        documents, as if they were spread evenly, so a partition may be larger where a
        list is dense: at most by as many rows as the documents between two cuts.
        Lists of one piece stay together unless they are that long.
        """
        into = F.floor(df * (doc_id / F.lit(float(max(1, self.n_docs)))))
        place = start + F.when(df > self.rows, F.least(into, df - 1)).otherwise(F.lit(0))
        return F.least(whole_div(place.cast("bigint"), self.rows), F.lit(self.n_parts - 1)).cast("int")


def layout_of(
    spark: SparkSession, n_shards: int, n_docs: int, n_postings: int, chunk_docs: int
) -> Layout:
    """As many partitions as a shuffle has, unless they would be very short or long."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = max(_LEAST_ROWS, min(_MOST_ROWS, -(-n_postings // tasks)))
    return Layout(n_shards, n_docs, n_postings, chunk_docs, rows)


def _piece(n_terms: int, n_shards: int) -> Column:
    """The piece of ``term_id`` in the order of (shard, term), of 262,144 pieces at most."""
    per_shard = -(-max(1, n_terms) // n_shards)
    per_piece = max(1, -(-per_shard * n_shards // _MOST_PIECES))
    term_id = F.col("term_id")
    order = shard_of(term_id, n_shards) * per_shard + whole_div(term_id, n_shards)
    return whole_div(order, per_piece).alias("_piece")


def _starts(lexicon: DataFrame, n_terms: int, n_shards: int) -> DataFrame:
    """(_piece, start): the postings of the pieces before, a small table for one window."""
    sums = lexicon.groupBy(_piece(n_terms, n_shards)).agg(F.sum("df").alias("_sum"))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    return stage(
        sums.select("_piece", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("start")),
        "places",
    )


def list_places(lexicon: DataFrame, n_terms: int, n_shards: int) -> DataFrame:
    """(term, term_id, df, start): the place of each list in the order of (shard, term).

    Lists that follow each other share a place: that of their piece. There are 262,144
    pieces at most, so their running total is broadcast.
    ``lexicon`` is a stored table and is read again by each use of the result.
    """
    starts = _starts(lexicon, n_terms, n_shards)
    ordered = lexicon.select("term", "term_id", "df", _piece(n_terms, n_shards))
    return ordered.join(F.broadcast(starts), "_piece").drop("_piece")


def join_places(rows: DataFrame, lexicon: DataFrame, n_terms: int, layout: Layout) -> DataFrame:
    """Rows (term_id, doc_id) with the ``df`` and ``start`` of their lists.

    A place follows from the piece of a term id, and the length matters only for lists that
    are cut into chunks or over partitions. Where these are few, no row moves for them, and
    ``df`` is 0 in all other lists. ``lexicon`` is a stored table.
    """
    cut = min(layout.chunk_docs, layout.rows)
    long = lexicon.filter(F.col("df") > cut).select("term_id", "df")
    if not few_keys(long):
        places = list_places(lexicon, n_terms, layout.n_shards).select("term_id", "df", "start")
        return join_weighted(rows, places, "term_id", "df", whole=True)
    starts = _starts(lexicon, n_terms, layout.n_shards)
    return (
        rows.select("term_id", "doc_id", _piece(n_terms, layout.n_shards))
        .join(F.broadcast(starts), "_piece")
        .join(F.broadcast(long), "term_id", "left")
        .select("term_id", "doc_id", F.coalesce("df", F.lit(0)).alias("df"), "start")
    )
