"""Writers of the tables in an index directory.

Posting files follow the order of (shard, term_id, doc_id) and are not hashed by shard: a
hot term is then cut over as many files as its length needs, and each task still writes
few shards. Which partition a posting belongs to is known from the lexicon
(``operators.layout``). Frequent terms are seen early and get low ids, so taking the id
modulo the shard count spreads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexipost.functions.numbers import whole_div
from lexipost.operators.codecs import encode
from lexipost.operators.dictionary import PIECE_DOCS, piece_of
from lexipost.operators.layout import Layout, shard_of

ROWS = "rows"  # flat posting rows, compressed by Parquet alone
_POSTINGS_PER_SHARD = 4_000_000
_MIN_SHARDS, _MAX_SHARDS = 8, 4096
# Sorted ids shrink to bit-packed differences when Parquet may delta-encode them.
_PARQUET = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary#doc_id": "false",
    "compression": "zstd",
}

# Terms are unique, so that a dictionary would only hold all of them once more.
_BLOOM = {
    "parquet.enable.dictionary#term": "false",
    "parquet.bloom.filter.enabled#term": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "compression": "zstd",
}


def default_shards(n_postings: int) -> int:
    return max(_MIN_SHARDS, min(_MAX_SHARDS, -(-n_postings // _POSTINGS_PER_SHARD)))


def write_docs(docs: DataFrame, path: str, piece_docs: int = PIECE_DOCS) -> None:
    """One directory per ``piece_docs`` ids, so that a lookup reads those it needs."""
    (
        docs.withColumn("piece", piece_of(F.col("doc_id"), piece_docs))
        .write.mode("overwrite")
        .partitionBy("piece")
        .parquet(f"{path}/docs")
    )


def write_lexicon(lexicon: DataFrame, path: str, by_range: bool = False) -> None:
    """Sorted by term, so that literal terms prune files and row groups.

    A batch whose terms lie all over the order skips row groups by their Bloom filters.
    With ``by_range`` the rows are dealt by ranges of terms already.
    """
    (
        (lexicon if by_range else lexicon.repartitionByRange("term"))
        .sortWithinPartitions("term")
        .write.mode("overwrite")
        .options(**_BLOOM)
        .parquet(f"{path}/lexicon")
    )


def write_postings(
    postings: DataFrame, path: str, layout: Layout, codec: str = ROWS
) -> None:
    """Write posting rows (term_id, chunk, doc_id, df, start), or their codes, once.

    The place of a list goes with its rows into the chunks, so that a payload moves once.
    """
    if codec == ROWS:
        rows, last = postings, "doc_id"
        part = layout.part(F.col("df"), F.col("start"), F.col("doc_id"))
        columns = ["term_id", "chunk", "doc_id"]
    else:
        encoded = encode(postings, codec, ["df", "start"])
        rows, last = encoded.withColumn("payload", F.unhex("payload")), "chunk"
        first = F.when(F.col("chunk") > 0, F.col("first_doc")).otherwise(F.lit(0))
        part = layout.part(F.col("df"), F.col("start"), first)
        columns = [c for c in encoded.columns if c not in ("df", "start")]
    order = ["shard", "term_id", last]
    (
        rows.select(*columns, part.alias("_part"))
        .repartitionById(layout.n_parts, "_part")
        .drop("_part")
        .withColumn("shard", shard_of(F.col("term_id"), layout.n_shards))
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .options(**_PARQUET)
        .partitionBy("shard")
        .parquet(f"{path}/postings")
    )


def write_segments(segments: DataFrame, path: str, n_docs: int | None = None) -> None:
    """One directory per block, each an index of its own; a large block takes many files.

    A block's documents have neighbouring ids, so equal widths of ids, as many as there
    are shuffle partitions, cut the rows by block without a look at them. ``n_docs`` is the
    number of documents; without it, the segments are read once more for their last one.
    """
    tasks = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n_docs is None:
        n_docs = (segments.agg(F.max("doc_id")).first()[0] or 0) + 1
    width = max(0, n_docs - 1) // tasks + 1
    (
        segments.select("term_id", "doc_id", "block")
        .repartitionById(tasks, whole_div("doc_id", width).cast("int"))
        .sortWithinPartitions("block", "term_id", "doc_id")
        .write.mode("overwrite")
        .options(**_PARQUET)
        .partitionBy("block")
        .parquet(path)
    )


def write_meta(meta: DataFrame, path: str) -> None:
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")
