"""Document and term dictionaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexipost.functions.numbers import whole_div
from lexipost.functions.text import distinct_tokens, document_path
from lexipost.operators.ranking import dense_ids
from lexipost.session import stage


PIECE_DOCS = 1 << 22


def piece_of(doc_id: Column, piece_docs: int) -> Column:
    """The directory of the stored document dictionary that holds an id."""
    return whole_div(doc_id, piece_docs)


def doc_dictionary(documents: DataFrame, first: int = 0) -> DataFrame:
    """Give each document its id: the rank by (block, name), from ``first``.

    Only the two key columns are read and sorted, never the text. A document
    without tokens takes an id too. A null or repeated key fails the job: its text would
    be lost, or counted for two documents.
    """
    said = F.lit("a document needs a block and a name of its own")
    keys = (
        documents.groupBy("block", "name")
        .agg(F.count("*").alias("_times"))
        .select(
            F.when(
                F.col("block").isNotNull() & F.col("name").isNotNull() & (F.col("_times") == 1),
                F.col("block"),
            )
            .otherwise(F.raise_error(said).cast("string"))
            .alias("block"),
            "name",
        )
    )
    return dense_ids(keys, ["block", "name"], "doc_id", first).select(
        "doc_id", document_path().alias("path"), "block", "name"
    )


def doc_terms(documents: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per document with its distinct terms in first-seen order.

    The text is reduced to distinct tokens before the join, so the shuffle by
    document key carries no repeats. Keys are unique, so no partition is hot. Both sides
    are sorted, which can spill; a broadcast would leave the tokens in as few partitions
    as the documents came in, for all the steps that read them. Tokens move as one string,
    which takes half the bytes of an array of them.
    """
    told = F.array_join(distinct_tokens("text"), " ").alias("_told")  # no token has a blank
    numbers = docs.select("block", "name", "doc_id")
    joined = documents.select("block", "name", told).hint("merge").join(numbers, ["block", "name"])
    none = F.array().cast("array<string>")
    terms = F.when(F.col("_told") == "", none).otherwise(F.split("_told", " "))
    return joined.select("doc_id", "block", terms.alias("terms"))


def doc_term_pairs(forward: DataFrame) -> DataFrame:
    """One row per distinct (document, term); pos orders the terms of a document."""
    return forward.select(
        "doc_id", "block", F.posexplode("terms").alias("pos", "term")
    ).withColumn("pos", F.col("pos").cast("bigint"))


def _first_seen(forward: DataFrame) -> DataFrame:
    # Three long buffers: the partial aggregation stays in the hash map of the
    # generated code, where a min of a struct would fall back to sorting.
    return (
        doc_term_pairs(forward)
        .groupBy("term")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.min_by("pos", "doc_id").alias("first_pos"),
            F.count("*").alias("df"),
        )
    )


def build_lexicon(forward: DataFrame, first: int = 0) -> DataFrame:
    """Give each term its id: the rank of its first occurrence, from ``first``."""
    return dense_ids(_first_seen(forward), ["first_doc", "first_pos"], "term_id", first).select(
        "term", "term_id", "df", "first_doc"
    )


def lexicon_segment(lexicon: DataFrame, forward: DataFrame) -> DataFrame:
    """What further documents add to ``lexicon``: (term, term_id, df, first_doc).

    One row per term of ``forward``, counted over it; known terms keep their id, new ones
    get the next. ``forward`` holds only documents that ``lexicon`` has not counted. Both
    sides of each join have one row per term, so no key is hot.
    """
    numbers = lexicon.select("term", "term_id")
    size = lexicon.count()
    seen = stage(_first_seen(forward).join(numbers, "term", "left"), "seen")
    fresh = dense_ids(
        seen.filter("term_id is null").drop("term_id"), ["first_doc", "first_pos"], "term_id", size
    )
    columns = ["term", "term_id", "df", "first_doc"]
    return seen.filter("term_id is not null").select(columns).unionByName(fresh.select(columns))


def whole_lexicon(segments: Sequence[DataFrame], by_range: bool = False) -> DataFrame:
    """One lexicon from those of segments that share their ids.

    With ``by_range`` it is dealt by ranges of terms, at no further shuffle.
    """
    rows = reduce(DataFrame.unionByName, segments)
    if by_range:
        rows = rows.repartitionByRange("term")
    if len(segments) == 1:
        return rows
    return (
        rows.groupBy("term", "term_id")
        .agg(F.sum("df").alias("df"), F.min("first_doc").alias("first_doc"))
    )


def extend_lexicon(lexicon: DataFrame, forward: DataFrame) -> DataFrame:
    """``lexicon`` with the terms of further documents; known terms keep their id."""
    return whole_lexicon([lexicon, lexicon_segment(lexicon, forward)])


def term_to_id(lexicon: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, term_id) for each row of ``terms`` that the lexicon knows."""
    return terms.select("term").distinct().join(lexicon.select("term", "term_id"), "term")


def id_to_term(lexicon: DataFrame, ids: DataFrame) -> DataFrame:
    """``ids`` with the term of each term_id; an unknown id gives no row."""
    return ids.join(lexicon.select("term_id", "term"), "term_id")


def id_to_path(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``ids`` with the path of each doc_id; an unknown id gives no row."""
    return ids.join(docs.select("doc_id", "path"), "doc_id")


def dictionary_sizes(lexicon: DataFrame, docs: DataFrame) -> DataFrame:
    """Entries in each dictionary."""
    count = F.count("*").alias("n_entries")
    return (
        docs.agg(count)
        .select(F.lit("docs").alias("dictionary"), "n_entries")
        .unionByName(lexicon.agg(count).select(F.lit("terms").alias("dictionary"), "n_entries"))
    )
