"""Building, opening, extending and merging indexes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexipost import schemas
from lexipost.functions.codes import check_codec
from lexipost.functions.literals import one_of
from lexipost.functions.text import document_path
from lexipost.operators.codecs import decode
from lexipost.operators.dictionary import (
    PIECE_DOCS,
    build_lexicon,
    doc_dictionary,
    doc_terms,
    lexicon_segment,
    whole_lexicon,
)
from lexipost.operators.inversion import CHUNK_DOCS, add_chunks, chunk_of, invert
from lexipost.operators.layout import join_places, layout_of, list_places
from lexipost.operators.ranking import dense_ids
from lexipost.operators.skew import join_weighted
from lexipost.session import stage
from lexipost.sinks import index as sinks
from lexipost.sources import index as sources


@dataclass(frozen=True)
class IndexMeta:
    n_docs: int
    n_terms: int
    n_postings: int
    n_shards: int
    chunk_docs: int
    piece_docs: int
    codec: str
    segments: tuple[str, ...]


@dataclass(frozen=True)
class TextIndex:
    """An index: segments with docs, lexicon and postings of their own, all read when used.

    Segments share one numbering of terms and follow each other in document ids. A build
    makes one segment; an extension adds one and leaves the others as they are.
    """

    spark: SparkSession
    path: str
    meta: IndexMeta

    @property
    def segments(self) -> list[str]:
        return [s if "/" in s else f"{self.path}/{s}" for s in self.meta.segments]

    @property
    def docs(self) -> DataFrame:
        parts = [sources.read_docs(self.spark, s) for s in self.segments]
        return reduce(DataFrame.unionByName, parts)

    @property
    def lexicon(self) -> DataFrame:
        return whole_lexicon([sources.read_lexicon(self.spark, s) for s in self.segments])

    def stored(self) -> list[DataFrame]:
        """The posting rows, or encoded chunks, of each segment as they are stored.

        A chunk number means the same list only within a segment.
        """
        plain = self.meta.codec == sinks.ROWS
        read = sources.read_posting_rows if plain else sources.read_encoded
        return [read(self.spark, s) for s in self.segments]

    def rows(self, stored: Sequence[DataFrame], n_postings: int = 0) -> DataFrame:
        """(term_id, chunk, doc_id) of stored tables, each decoded by itself."""
        if self.meta.codec == sinks.ROWS:
            found = [s.select("term_id", "chunk", "doc_id") for s in stored]
        else:
            found = [
                decode(s.withColumn("payload", F.hex("payload")), self.meta.codec, n_postings)
                for s in stored
            ]
        return reduce(DataFrame.unionByName, found)

    def postings(self) -> DataFrame:
        """Every posting row (term_id, chunk, doc_id), in no particular order.

        Lists that several segments hold are cut anew, by what they are as a whole.
        """
        rows = self.rows(self.stored(), self.meta.n_postings)
        if len(self.meta.segments) == 1:
            return rows
        lexicon, meta = stage(self.lexicon, "lexicon"), self.meta
        return add_chunks(rows, lexicon, meta.chunk_docs, n_docs=meta.n_docs)

    def scan(self) -> DataFrame:
        """(term_id, doc_id) in order of both."""
        rows = self.rows(self.stored(), self.meta.n_postings)
        return rows.select("term_id", "doc_id").orderBy("term_id", "doc_id")

    def stored_of(self, term_ids: list[int]) -> list[DataFrame]:
        """What is stored, by segment, of a query-sized list of terms.

        The literals prune shard directories and then row groups.
        """
        shards = sorted({term_id % self.meta.n_shards for term_id in term_ids})
        wanted = f"({one_of('shard', shards)}) and ({one_of('term_id', term_ids)})"
        return [s.filter(wanted) for s in self.stored()]

    def postings_of(self, term_ids: list[int]) -> DataFrame:
        """The posting rows of a query-sized list of terms."""
        return self.rows(self.stored_of(term_ids))


def open_index(spark: SparkSession, path: str) -> TextIndex:
    row = sources.read_meta(spark, path).first().asDict()
    return TextIndex(spark, path, IndexMeta(**row | {"segments": tuple(row["segments"])}))


def _new_segment() -> str:
    """The folder of one segment in an index directory.

    A build or extension writes into a folder of its own. ``meta``, which names the
    segments that count, is written last, so a build that fails leaves the index as it
    was. Earlier segments stay, for readers that have them open and for indexes that were
    extended from them, until the user removes them.
    """
    return f"segment-{uuid.uuid4().hex}"


def _publish(spark: SparkSession, path: str, meta: IndexMeta) -> TextIndex:
    values = asdict(meta) | {"segments": list(meta.segments)}
    sinks.write_meta(spark.createDataFrame([values], schemas.META), path)
    return TextIndex(spark, path, meta)


def _totals(lexicon: DataFrame) -> tuple[int, int]:
    size = lexicon.agg(F.count("*").alias("terms"), F.coalesce(F.sum("df"), F.lit(0)).alias("rows"))
    return tuple(size.first())


def forward_table(
    spark: SparkSession, documents: DataFrame, path: str, piece_docs: int
) -> DataFrame:
    """Number the documents into ``path`` and stage their distinct terms.

    The staged table is read by the lexicon and by the inversion, so the texts are
    tokenised once.
    """
    sinks.write_docs(doc_dictionary(documents), path, piece_docs)
    return stage(doc_terms(documents, sources.read_docs(spark, path)), "forward")


def lexicon_table(spark: SparkSession, forward: DataFrame, path: str) -> DataFrame:
    sinks.write_lexicon(build_lexicon(forward), path)
    return sources.read_lexicon(spark, path)


def build_index(
    documents: DataFrame,
    path: str,
    codec: str = sinks.ROWS,
    n_shards: int | None = None,
    chunk_docs: int = CHUNK_DOCS,
    piece_docs: int = PIECE_DOCS,
) -> TextIndex:
    """Index ``documents`` (block, name, text) into ``path``, replacing what is there.

    ``codec`` is 'rows' for flat Parquet rows, or 'raw', 'vb' or 'gamma' to store
    encoded lists.
    """
    if codec != sinks.ROWS:
        check_codec(codec)
    spark = documents.sparkSession
    segment = _new_segment()
    tables = f"{path}/{segment}"
    forward = forward_table(spark, documents, tables, piece_docs)
    lexicon = lexicon_table(spark, forward, tables)
    n_docs = sources.read_docs(spark, tables).count()
    n_terms, n_postings = _totals(lexicon)
    n_shards = n_shards or sinks.default_shards(n_postings)
    places = list_places(lexicon, n_terms, n_shards)
    postings = invert(forward, places, chunk_docs, ["df", "start"], n_docs)
    layout = layout_of(spark, n_shards, n_docs, n_postings, chunk_docs)
    sinks.write_postings(postings, tables, layout, codec)
    meta = IndexMeta(
        n_docs, n_terms, n_postings, n_shards, chunk_docs, piece_docs, codec, (segment,)
    )
    return _publish(spark, path, meta)


def extend_index(index: TextIndex, documents: DataFrame, path: str | None = None) -> TextIndex:
    """Index further documents on top of ``index``: one more segment, nothing rewritten.

    Without ``path`` the segment goes into the index's own directory; with one, a new
    index there names the segments of ``index``, which must be kept, and its own. Ids in
    use stay; new documents and terms get the next ones. A document whose path is indexed
    already is skipped, so repeating a batch changes nothing. The result equals a full
    build when the new blocks sort after the old ones. The segment's lexicon counts its
    own documents alone. ``compact_index`` joins the segments into one.
    """
    spark, old = index.spark, index.meta
    path = (path or index.path).rstrip("/")
    here = path == index.path.rstrip("/")
    keys = documents.select("block", "name").join(
        index.docs.select("block", "name"), ["block", "name"], "left_anti"
    )
    segment = _new_segment()
    tables = f"{path}/{segment}"
    sinks.write_docs(doc_dictionary(keys, old.n_docs), tables, old.piece_docs)
    fresh = sources.read_docs(spark, tables)
    n_docs = old.n_docs + fresh.count()
    earlier = old.segments if here else tuple(index.segments)
    if n_docs == old.n_docs:
        return _publish(spark, path, IndexMeta(**asdict(old) | {"segments": earlier}))
    forward = stage(doc_terms(documents, fresh), "forward")
    sinks.write_lexicon(lexicon_segment(index.lexicon, forward), tables)
    own = sources.read_lexicon(spark, tables)
    n_own, n_postings = _totals(own)
    new_terms = own.filter(F.col("term_id") >= old.n_terms).count()
    n_terms = old.n_terms + new_terms
    # The places of the segment's own lists; ids that it does not use leave no gap.
    places = list_places(own, n_terms, old.n_shards)
    postings = invert(
        forward, places, old.chunk_docs, ["df", "start"], n_docs - old.n_docs
    )
    layout = layout_of(spark, old.n_shards, n_docs, n_postings, old.chunk_docs)
    sinks.write_postings(postings, tables, layout, old.codec)
    meta = IndexMeta(
        n_docs,
        n_terms,
        old.n_postings + n_postings,
        old.n_shards,
        old.chunk_docs,
        old.piece_docs,
        old.codec,
        (*earlier, segment),
    )
    return _publish(spark, path, meta)


def _written_whole(
    spark: SparkSession,
    path: str,
    docs: DataFrame,
    lexicon: DataFrame,
    rows: DataFrame,
    n_shards: int | None,
    chunk_docs: int,
    piece_docs: int,
    codec: str,
    by_range: bool = False,
) -> TextIndex:
    """An index of one segment from its three tables; ``rows`` are (term_id, doc_id).

    With ``by_range`` the lexicon is dealt by ranges of terms.
    """
    segment = _new_segment()
    tables = f"{path}/{segment}"
    sinks.write_docs(docs, tables, piece_docs)
    sinks.write_lexicon(lexicon, tables, by_range)
    lexicon = sources.read_lexicon(spark, tables)
    n_docs = sources.read_docs(spark, tables).count()
    n_terms, n_postings = _totals(lexicon)
    n_shards = n_shards or sinks.default_shards(n_postings)
    layout = layout_of(spark, n_shards, n_docs, n_postings, chunk_docs)
    placed = join_places(rows, lexicon, n_terms, layout)
    chunk = chunk_of(F.col("df"), chunk_docs, n_docs).alias("chunk")
    postings = placed.select("term_id", chunk, "doc_id", "df", "start")
    sinks.write_postings(postings, tables, layout, codec)
    meta = IndexMeta(
        n_docs, n_terms, n_postings, n_shards, chunk_docs, piece_docs, codec, (segment,)
    )
    return _publish(spark, path, meta)


def compact_index(index: TextIndex, path: str | None = None) -> TextIndex:
    """The index with its segments joined into one, in its own or another directory.

    Ids stay as they are; lists that grew over several segments are cut and encoded anew.
    """
    meta = index.meta
    docs = index.docs.drop("piece")
    rows = index.rows(index.stored(), meta.n_postings)
    lexicon = whole_lexicon([sources.read_lexicon(index.spark, s) for s in index.segments], True)
    return _written_whole(
        index.spark, (path or index.path).rstrip("/"), docs, lexicon, rows, None,
        meta.chunk_docs, meta.piece_docs, meta.codec, True,
    )


def _owned(
    indexes: Sequence[TextIndex], docs: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Posting rows (place, term_id, doc_id) under the new document ids, and their terms.

    A document that several indexes hold is taken from the first of them. ``docs`` has
    (doc_id, block, name) of all. Each document is in one of the tables that its postings
    meet, with few postings, so that join has no hot key.
    """
    held = reduce(
        DataFrame.unionByName,
        [
            index.docs.select("block", "name", F.lit(i).alias("place"), F.col("doc_id").alias("old"))
            for i, index in enumerate(indexes)
        ],
    )
    owners = held.groupBy("block", "name").agg(F.min(F.struct("place", "old")).alias("of"))
    numbers = stage(
        owners.join(docs, ["block", "name"]).select("of.place", "of.old", "doc_id"), "owners"
    )
    rows, terms = [], []
    for i, index in enumerate(indexes):
        own = numbers.filter(F.col("place") == i).select("old", "doc_id")
        stored = index.rows(index.stored(), index.meta.n_postings).select("term_id", F.col("doc_id").alias("old"))
        rows.append(stored.join(own, "old").select(F.lit(i).alias("place"), "term_id", "doc_id"))
        terms.append(index.lexicon.select(F.lit(i).alias("place"), "term_id", "term"))
    return (
        stage(reduce(DataFrame.unionByName, rows), "owned"),
        reduce(DataFrame.unionByName, terms),
    )


def merge_indexes(
    indexes: Sequence[TextIndex],
    path: str,
    codec: str | None = None,
    n_shards: int | None = None,
) -> TextIndex:
    """One index in ``path`` from several that have dictionaries of their own.

    Documents are numbered by (block, name) over all inputs. One that several inputs hold
    is taken from the first of them, with the terms that it has there. Terms are numbered
    by their first document and, within it, by their order in the input that it comes from.
    The result equals a full build over all documents if each input numbers its documents
    by (block, name), as builds do. Codec and sizes are those of the first input.

    No term or document is broadcast but the heaviest terms (``join_weighted``).
    """
    if not indexes:
        raise ValueError("there is no index to merge")
    spark, meta = indexes[0].spark, indexes[0].meta
    codec = codec or meta.codec
    if codec != sinks.ROWS:
        check_codec(codec)
    keys = reduce(
        DataFrame.unionByName, [index.docs.select("block", "name") for index in indexes]
    ).distinct()
    docs = stage(dense_ids(keys, ["block", "name"], "doc_id"), "merged-docs")
    rows, terms = _owned(indexes, docs)
    uses = rows.groupBy("place", "term_id").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first_doc")
    )
    known = stage(uses.join(terms, ["place", "term_id"]), "merged-terms")
    # A term's first document has one owner, in whose order its new terms are numbered.
    seen = known.groupBy("term").agg(
        F.min("first_doc").alias("first_doc"),
        F.min_by("term_id", "first_doc").alias("in_doc"),
        F.sum("n").alias("df"),
    )
    lexicon = stage(
        dense_ids(seen, ["first_doc", "in_doc"], "new_id").select(
            "term", F.col("new_id").alias("term_id"), "df", "first_doc"
        ),
        "merged-lexicon",
    )
    # The rows of one term in one input are one key, weighed by their number.
    key = (F.col("term_id") * len(indexes) + F.col("place")).alias("_term")
    renamed = stage(
        known.select(key, "n", "term").join(
            lexicon.select("term", F.col("term_id").alias("new_id")), "term"
        ).drop("term"),
        "merged-ids",
    )
    merged = join_weighted(rows.select(key, "doc_id"), renamed, "_term", "n", whole=True).select(
        F.col("new_id").alias("term_id"), "doc_id"
    )
    listed = docs.select("doc_id", document_path().alias("path"), "block", "name")
    return _written_whole(
        spark, path.rstrip("/"), listed, lexicon, merged, n_shards,
        meta.chunk_docs, meta.piece_docs, codec,
    )
