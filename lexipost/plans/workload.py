"""The queries that ``__spark_entry__`` registers, one per operator.

Every query takes (spark, sf_dir) and reads the ``documents`` table there, with
``source`` as block and the table's id as file name. Queries that ask an index
share the one that the first of them builds, and so do those that start from the
staged forward table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexipost.functions.text import document_path, normal_path, tokens
from lexipost.operators import codecs, compare, dictionary, gaps, inversion, retrieval, stats
from lexipost.operators.inversion import CHUNK_DOCS
from lexipost.operators.ranking import rank_in_group
from lexipost.plans.index import (
    TextIndex,
    build_index,
    compact_index,
    extend_index,
    forward_table,
    merge_indexes,
)
from lexipost.session import new_stage_path, stage
from lexipost.sinks.files import write_corpus, write_expected, write_queries
from lexipost.sinks.index import write_segments
from lexipost.sinks.results import write_results
from lexipost.sources.batches import read_expected, read_queries
from lexipost.sources.corpus import read_corpus
from lexipost.sources.index import read_segments
from lexipost.sources.tables import queries_from_rows, read_documents

Query = Callable[[SparkSession, str], DataFrame]

# A batch with frequent, case-differing, repeated, unknown and no tokens, and an
# edited copy of it for the comparisons.
BATCH = [
    (1, "the and of"),
    (2, "in the"),
    (3, "The the"),
    (4, "the the"),
    (5, "zzzz the"),
    (6, ""),
    (7, " que\nde "),
    (8, "was for with that"),
]
EDITED_BATCH = [
    (1, "the and in"),
    (2, "the in"),
    (3, "The"),
    (4, "the"),
    (5, "zzzz"),
    (6, "des"),
    (7, "que la"),
    (8, "that was"),
]
LAST_BASE_BLOCK = "src15"  # blocks from here on arrive as the second batch

CUT_DOCS = 64  # chunks so short that many lists are cut

_built: dict[tuple[str, str, str, int], TextIndex] = {}
_forward_tables: dict[tuple[str, str], DataFrame] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet", "source", "doc_id")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole benchmark texts as queries: documents that hold all their tokens."""
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        F.col("item_id").alias("qid"), F.col("text").alias("query")
    )


def index_of(
    spark: SparkSession, sf_dir: str, codec: str = "rows", chunk_docs: int = CHUNK_DOCS
) -> TextIndex:
    key = (spark.conf.get("spark.app.id"), sf_dir, codec, chunk_docs)
    if key not in _built:
        path = new_stage_path(spark, f"index-{codec}")
        _built[key] = build_index(documents(spark, sf_dir), path, codec, chunk_docs=chunk_docs)
    return _built[key]


def _batch(spark: SparkSession) -> DataFrame:
    return queries_from_rows(spark, BATCH)


def _forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct terms of each document, staged as a build stages them.

    Documents are numbered for it as a build numbers them; no postings are needed.
    """
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _forward_tables:
        path = new_stage_path(spark, "dictionary")
        _forward_tables[key] = forward_table(
            spark, documents(spark, sf_dir), path, dictionary.PIECE_DOCS
        )
    return _forward_tables[key]


def _inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posting rows of the forward table under its own lexicon."""
    forward = _forward(spark, sf_dir)
    return inversion.invert(forward, dictionary.build_lexicon(forward))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inversion.block_segments(_inverted(spark, sf_dir))


def _item_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.query_terms(items(spark, sf_dir)).select("term").distinct()


def documents_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("block", "name", document_path().alias("path"), "text")


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        document_path().alias("path"), F.posexplode(tokens("text")).alias("pos", "token")
    ).withColumn("pos", F.col("pos").cast("bigint"))


def query_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.query_terms(items(spark, sf_dir))


def normalize_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four spellings of every document path."""
    written = F.explode(
        F.array(
            F.concat(F.lit("./"), "block", F.lit("/"), "name"),
            F.concat("block", F.lit("\\"), "name"),
            F.concat("block", F.lit("//"), "name", F.lit("/")),
            F.concat(F.lit("a/../"), "block", F.lit("/./"), "name"),
        )
    )
    return (
        documents(spark, sf_dir)
        .select(written.alias("written"))
        .select("written", normal_path("written").alias("path"))
    )


def doc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.doc_dictionary(documents(spark, sf_dir))


def doc_term_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.doc_term_pairs(_forward(spark, sf_dir)).select("doc_id", "term", "pos")


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.build_lexicon(_forward(spark, sf_dir)).select("term", "term_id", "df")


def _two_batches(spark: SparkSession, sf_dir: str) -> TextIndex:
    """An index of the first blocks, to which the rest is appended as a segment."""
    everything = documents(spark, sf_dir)
    base = build_index(
        everything.filter(F.col("block") < LAST_BASE_BLOCK), new_stage_path(spark, "base")
    )
    return extend_index(base, everything.filter(F.col("block") >= LAST_BASE_BLOCK))


def _extended(spark: SparkSession, sf_dir: str) -> TextIndex:
    """As ``_two_batches``, built once for the queries that ask it."""
    key = (spark.conf.get("spark.app.id"), sf_dir, "extended", CHUNK_DOCS)
    if key not in _built:
        _built[key] = _two_batches(spark, sf_dir)
    return _built[key]


def lexicon_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicon of the first blocks, extended by the documents of the rest."""
    forward = _forward(spark, sf_dir)
    base = dictionary.build_lexicon(forward.filter(F.col("block") < LAST_BASE_BLOCK))
    rest = forward.filter(F.col("block") >= LAST_BASE_BLOCK)
    return dictionary.extend_lexicon(stage(base, "base-lexicon"), rest).select(
        "term", "term_id", "df"
    )


def index_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_batches(spark, sf_dir).scan()


def index_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both segments of an extended index joined into one and read back."""
    return compact_index(_extended(spark, sf_dir)).postings().select("term_id", "doc_id")


def merged_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three indexes with dictionaries of their own and shared documents, merged into one."""
    everything, block = documents(spark, sf_dir), F.col("block")
    parts = [
        build_index(everything.filter(part), new_stage_path(spark, "part"), codec)
        for part, codec in (
            (block >= "src14", "rows"),
            ((block >= "src1") & (block < "src3"), "vb"),
            (block < LAST_BASE_BLOCK, "rows"),
        )
    ]
    merged = merge_indexes(parts, new_stage_path(spark, "merged"))
    lists = merged.lexicon.select("term_id", "term", "df")
    return merged.postings().join(lists, "term_id").select("term", "term_id", "doc_id", "df")


def retrieve_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch on an index of two segments."""
    return retrieval.retrieve(_extended(spark, sf_dir), _batch(spark))


def retrieve_extended_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark's texts on an index of two segments, on the path for large batches."""
    return retrieval.retrieve(_extended(spark, sf_dir), items(spark, sf_dir), cap=0)


def term_to_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.term_to_id(index_of(spark, sf_dir).lexicon, _item_terms(spark, sf_dir))


def id_to_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = index_of(spark, sf_dir)
    return dictionary.id_to_term(index.lexicon, inversion.document_frequency(index.postings()))


def id_to_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path of the document that first used each term."""
    index = index_of(spark, sf_dir)
    firsts = index.lexicon.select("term_id", F.col("first_doc").alias("doc_id"))
    return dictionary.id_to_path(index.docs, firsts)


def dictionary_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = index_of(spark, sf_dir)
    return dictionary.dictionary_sizes(index.lexicon, index.docs)


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inverted(spark, sf_dir).select("term_id", "doc_id")


def posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inversion.posting_lists(index_of(spark, sf_dir).postings()).select(
        "term_id", "chunk", F.array_join("doc_ids", " ").alias("doc_ids")
    )


def block_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir)


def merge_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the segment of each block, then merge three overlapping groups of blocks."""
    path = new_stage_path(spark, "segments")
    write_segments(_segments(spark, sf_dir), path, _forward(spark, sf_dir).count())
    segments = read_segments(spark, path)
    block = F.col("block")
    return inversion.merge_segments(
        [
            segments.filter(block < LAST_BASE_BLOCK),
            segments.filter((block >= "src1") & (block < "src3")),
            segments.filter(block >= "src14"),
        ]
    )


def build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full build, read back as (term, path)."""
    index = build_index(documents(spark, sf_dir), new_stage_path(spark, "index"))
    spelled = dictionary.id_to_term(index.lexicon, index.postings())
    return dictionary.id_to_path(index.docs, spelled).select("term", "path")


def index_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_of(spark, sf_dir).scan()


def term_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inversion.document_frequency(index_of(spark, sf_dir).postings())


def term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = index_of(spark, sf_dir)
    return stats.term_stats(index.postings(), rows=index.meta.n_postings)


def index_size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = index_of(spark, sf_dir)
    return stats.size_report(index.postings(), rows=index.meta.n_postings)


def postings_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.postings_lookup(index_of(spark, sf_dir), _item_terms(spark, sf_dir))


def postings_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.terms_intersect(index_of(spark, sf_dir), "the", "of")


def retrieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.retrieve(index_of(spark, sf_dir), _batch(spark))


def retrieve_rarest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.retrieve_rarest_first(index_of(spark, sf_dir), _batch(spark))


def retrieve_by_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.retrieve_by_division(index_of(spark, sf_dir), _batch(spark))


def retrieve_by_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.retrieve_by_scan(documents(spark, sf_dir), _batch(spark))


def retrieve_by_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.retrieve_by_bitmaps(index_of(spark, sf_dir), _batch(spark))


def retrieve_by_bitmaps_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark's texts by bitmaps, on the path for batches of any size."""
    return retrieval.retrieve_by_bitmaps(index_of(spark, sf_dir), items(spark, sf_dir), cap=0)


def retrieve_by_scan_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark's texts without an index, on the path for batches of any size."""
    return retrieval.retrieve_by_scan(documents(spark, sf_dir), items(spark, sf_dir), cap=0)


def retrieve_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.retrieve_rarest_first(index_of(spark, sf_dir), items(spark, sf_dir))


def retrieve_items_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on the path for batches of any size, which broadcasts nothing."""
    return retrieval.retrieve(index_of(spark, sf_dir), items(spark, sf_dir), cap=0)


def _retrieve_encoded(codec: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return retrieval.retrieve(index_of(spark, sf_dir, codec), _batch(spark))

    return query


def _ranked(spark: SparkSession, sf_dir: str, rows: list[tuple[int, str]]) -> DataFrame:
    found = retrieval.retrieve(index_of(spark, sf_dir), queries_from_rows(spark, rows))
    return rank_in_group(found, "qid", "doc_id")


def result_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = index_of(spark, sf_dir)
    ours = retrieval.retrieve(index, _batch(spark))
    theirs = retrieval.retrieve(index, queries_from_rows(spark, EDITED_BATCH))
    return compare.set_difference(ours, theirs, ["qid", "path"])


def validate_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.validate(
        _batch(spark), _ranked(spark, sf_dir, BATCH), _ranked(spark, sf_dir, EDITED_BATCH)
    )


def first_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.first_mismatch(
        _ranked(spark, sf_dir, BATCH), _ranked(spark, sf_dir, EDITED_BATCH)
    )


def result_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the results as text files and read the lines back."""
    path = new_stage_path(spark, "results")
    write_results(retrieve(spark, sf_dir), path, _batch(spark))
    lines = spark.read.schema("path string, qid bigint").text(path)
    return lines.select("qid", "path").filter("path <> ''")


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to a corpus directory and read back."""
    root = new_stage_path(spark, "corpus")
    write_corpus(documents(spark, sf_dir), root)
    return read_corpus(spark, root)


def query_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_stage_path(spark, "query-files")
    write_queries(items(spark, sf_dir), folder)
    return read_queries(spark, folder)


def expected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_stage_path(spark, "expected-files")
    write_expected(_ranked(spark, sf_dir, BATCH), _batch(spark), folder)
    return read_expected(spark, folder)


def gap_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = index_of(spark, sf_dir)
    found = gaps.gaps(index.postings(), n_postings=index.meta.n_postings)
    return found.select("term_id", "doc_id", "gap")


def gap_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps by their place in the chunk, without the ids that they stand for."""
    index = index_of(spark, sf_dir)
    gapped = gaps.with_base(gaps.gaps(index.postings(), n_postings=index.meta.n_postings))
    place = Window.partitionBy("term_id", "chunk").orderBy("doc_id")
    by_place = gapped.select(
        "term_id", "chunk", "base", F.row_number().over(place).alias("pos"), "gap"
    )
    return gaps.gaps_to_postings(by_place).select("term_id", "doc_id")


def _encode(codec: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return codecs.encode(index_of(spark, sf_dir).postings(), codec).select(
            "term_id", "chunk", "n_postings", "payload"
        )

    return query


def _decode(codec: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return index_of(spark, sf_dir, codec).postings().select("term_id", "doc_id")

    return query


def _encode_cut(codec: str) -> Query:
    """The payload of every whole list, joined from the chunks of lists that are cut."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        chunks = codecs.encode(index_of(spark, sf_dir, chunk_docs=CUT_DOCS).postings(), codec)
        in_order = F.sort_array(F.collect_list(F.struct("chunk", "payload")))
        return chunks.groupBy("term_id").agg(
            F.sum("n_postings").alias("n_postings"),
            F.array_join(F.transform(in_order, lambda c: c["payload"]), "").alias("payload"),
        )

    return query


def decode_gamma_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_of(spark, sf_dir, "gamma", CUT_DOCS).postings().select("term_id", "doc_id")


def term_stats_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = index_of(spark, sf_dir, chunk_docs=CUT_DOCS)
    return stats.term_stats(index.postings(), rows=index.meta.n_postings)


def retrieve_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.retrieve(index_of(spark, sf_dir, "gamma", CUT_DOCS), _batch(spark))


def retrieve_gamma_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark's texts on a gamma index, on the path for batches of any size."""
    index = index_of(spark, sf_dir, "gamma", CUT_DOCS)
    return retrieval.retrieve(index, items(spark, sf_dir), cap=0)


def codec_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codecs.round_trip(index_of(spark, sf_dir).postings())


QUERIES: dict[str, Query] = {
    "documents_catalog": documents_catalog,
    "tokenize": tokenize,
    "query_tokens": query_tokens,
    "normalize_paths": normalize_paths,
    "doc_dictionary": doc_dictionary,
    "doc_term_pairs": doc_term_pairs,
    "lexicon": lexicon,
    "lexicon_extend": lexicon_extend,
    "index_extend": index_extend,
    "index_compact": index_compact,
    "merge_indexes": merged_indexes,
    "retrieve_extended": retrieve_extended,
    "retrieve_extended_joined": retrieve_extended_joined,
    "term_to_id": term_to_id,
    "id_to_term": id_to_term,
    "id_to_path": id_to_path,
    "dictionary_sizes": dictionary_sizes,
    "postings": postings,
    "posting_lists": posting_lists,
    "block_segments": block_segments,
    "merge_segments": merge_segments,
    "build_index": build,
    "index_scan": index_scan,
    "term_df": term_df,
    "term_stats": term_stats,
    "index_size_report": index_size_report,
    "postings_lookup": postings_lookup,
    "postings_intersect": postings_intersect,
    "retrieve": retrieve,
    "retrieve_by_division": retrieve_by_division,
    "retrieve_rarest_first": retrieve_rarest_first,
    "retrieve_by_scan": retrieve_by_scan,
    "retrieve_by_scan_joined": retrieve_by_scan_joined,
    "retrieve_by_bitmaps": retrieve_by_bitmaps,
    "retrieve_by_bitmaps_joined": retrieve_by_bitmaps_joined,
    "retrieve_items": retrieve_items,
    "retrieve_items_joined": retrieve_items_joined,
    "retrieve_raw": _retrieve_encoded("raw"),
    "retrieve_vb": _retrieve_encoded("vb"),
    "retrieve_gamma": _retrieve_encoded("gamma"),
    "result_difference": result_difference,
    "validate_results": validate_results,
    "first_mismatch": first_mismatch,
    "result_files": result_files,
    "corpus_files": corpus_files,
    "query_files": query_files,
    "expected_files": expected_files,
    "gaps": gap_encode,
    "gaps_to_postings": gap_decode,
    "encode_raw": _encode("raw"),
    "encode_vb": _encode("vb"),
    "encode_gamma": _encode("gamma"),
    "decode_raw": _decode("raw"),
    "decode_vb": _decode("vb"),
    "decode_gamma": _decode("gamma"),
    "encode_vb_cut": _encode_cut("vb"),
    "encode_gamma_cut": _encode_cut("gamma"),
    "decode_gamma_cut": decode_gamma_cut,
    "term_stats_cut": term_stats_cut,
    "retrieve_cut": retrieve_cut,
    "retrieve_gamma_joined": retrieve_gamma_joined,
    "codec_roundtrip": codec_roundtrip,
}
