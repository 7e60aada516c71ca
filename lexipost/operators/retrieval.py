"""Conjunctive retrieval: the documents that hold every token of a query.

Queries come as a table (qid, query); one query is a table of one row. A query
with a token that the lexicon does not know, or without tokens, has no results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexipost.functions.literals import MOST_LITERALS, one_of
from lexipost.functions.numbers import whole_div
from lexipost.functions.text import distinct_tokens, document_path
from lexipost.operators.dictionary import piece_of
from lexipost.operators.inversion import CHUNK_DOCS, widest_range
from lexipost.operators.skew import (
    BATCH_ROWS,
    BROADCAST_ROWS,
    fetch_batch,
    join_weighted,
    spread,
)
from lexipost.session import stage

if TYPE_CHECKING:
    from lexipost.plans.index import TextIndex

_ASKED_ROWS = 1 << 10  # queries of a term that meet a part of its list in one task
_BUCKET_DOCS = 1 << 15  # documents in a bitmap of Spark's functions


def checked_queries(queries: DataFrame) -> DataFrame:
    """(qid, query), failing on a null or repeated qid: its answers could not be told apart."""
    said = F.lit("a query needs a qid of its own")
    return (
        queries.groupBy("qid")
        .agg(F.count("*").alias("_times"), F.first("query").alias("query"))
        .select(
            F.when(F.col("qid").isNotNull() & (F.col("_times") == 1), F.col("qid"))
            .otherwise(F.raise_error(said).cast("bigint"))
            .alias("qid"),
            "query",
        )
    )


def query_terms(queries: DataFrame) -> DataFrame:
    """(qid, term, n_terms): the distinct tokens of each query and their number."""
    return (
        checked_queries(queries)
        .select("qid", distinct_tokens("query").alias("terms"))
        .withColumn("n_terms", F.size("terms").cast("bigint"))
        .select("qid", F.explode("terms").alias("term"), "n_terms")
    )


def _known_terms(lexicon: DataFrame, asked: DataFrame, terms: set[str]) -> DataFrame:
    """``asked``, a local table with a term column, joined with the lexicon.

    Up to 256 terms also go into the scan as literals: the lexicon is sorted by term and
    has Bloom filters, so they skip most of its row groups.
    """
    entries = lexicon.select("term", "term_id", "df")
    if len(terms) <= MOST_LITERALS:
        entries = entries.filter(one_of("term", sorted(terms)))
    return entries.join(F.broadcast(asked), "term")


@dataclass(frozen=True)
class ResolvedBatch:
    """Answerable queries: (qid, terms), terms an array of (df, term_id), rarest first.

    A small batch, of checked size, also lists the ids of the rarest terms, of the second
    rarest and of all but the rarest. ``lead_rows`` is then the number of postings of the
    rarest terms, which bounds the results, and ``check_rows`` that of the memberships to
    check.
    """

    queries: DataFrame
    small: bool = False
    lead_ids: list[int] = field(default_factory=list)
    second_ids: list[int] = field(default_factory=list)
    other_ids: list[int] = field(default_factory=list)
    lead_rows: int = 0
    check_rows: int = 0


_RESOLVED = "qid bigint, terms array<struct<df: bigint, term_id: bigint>>"


def _answerable(found: DataFrame) -> DataFrame:
    # The array is as long as the query, which was one string in one row before.
    return (
        found.groupBy("qid", "n_terms")
        .agg(F.sort_array(F.collect_list(F.struct("df", "term_id"))).alias("terms"))
        .filter(F.size("terms") == F.col("n_terms"))
        .select("qid", "terms")
    )


def resolve(lexicon: DataFrame, queries: DataFrame, cap: int = BATCH_ROWS) -> ResolvedBatch:
    """Look the tokens of a batch up in the lexicon.

    Up to ``cap`` (query, token) rows become a local table. The lexicon is unique by
    term, so the answer has no more rows than were asked for and is taken to the
    driver too, where its ids prune the postings scan. A larger batch stays
    distributed.
    """
    wanted = query_terms(queries)
    asked = fetch_batch(wanted, cap)
    if asked is not None:
        spark = lexicon.sparkSession
        local = spark.createDataFrame(asked, wanted.schema)
        found = _known_terms(lexicon, local, {row.term for row in asked})
        plans = _answerable(found).collect()
        return ResolvedBatch(
            spark.createDataFrame(plans, _RESOLVED),
            True,
            sorted({plan.terms[0].term_id for plan in plans}),
            sorted({plan.terms[1].term_id for plan in plans if len(plan.terms) > 1}),
            sorted({term.term_id for plan in plans for term in plan.terms[1:]}),
            sum(plan.terms[0].df for plan in plans),
            sum(plan.terms[0].df * (len(plan.terms) - 1) for plan in plans),
        )
    # One row per term on both sides first, so that a token which most queries
    # share meets the lexicon once; its rows are then joined as a heavy key.
    uses = wanted.groupBy("term").agg(F.count("*").alias("uses"))
    entries = lexicon.select("term", "term_id", "df")
    known = stage(uses.join(entries, "term"), "query-terms")
    return ResolvedBatch(stage(_answerable(join_weighted(wanted, known, "term", "uses")), "queries"))


def _with_paths(index: TextIndex, batch: ResolvedBatch, hits: DataFrame) -> DataFrame:
    """Results of a known, small bound are sent to the dictionary; others meet it
    in a shuffle. Joining on the directory number too lets Spark skip, at run time,
    the dictionary directories that no result falls into.
    """
    hits = hits.withColumn("piece", piece_of(F.col("doc_id"), index.meta.piece_docs))
    if batch.small and batch.lead_rows <= BROADCAST_ROWS:
        hits = F.broadcast(hits)
    return index.docs.join(hits, ["piece", "doc_id"]).select("qid", "doc_id", "path")


def _asked_terms(batch: ResolvedBatch) -> DataFrame:
    """(term_id, df, uses): the lists that a large batch asks for, and how many queries do."""
    terms = batch.queries.select(F.explode("terms").alias("term")).select("term.*")
    return stage(terms.groupBy("term_id", "df").agg(F.count("*").alias("uses")), "asked-terms")


def _asked_lists(index: TextIndex, terms: DataFrame) -> DataFrame:
    """(term_id, doc_id, df, uses): the lists of ``terms``, from one scan of the postings.

    Encoded chunks meet the asked terms before they are decoded. What is found serves all
    steps of the retrieval and is staged.
    """
    stored = index.stored()
    if index.meta.codec != "rows":
        lists = terms.select("term_id", "df")
        stored = [join_weighted(s, lists, "term_id", "df").select(s.columns) for s in stored]
    rows = index.rows(stored).select("term_id", "doc_id")
    return stage(join_weighted(rows, terms, "term_id", "df"), "asked-lists")


def _meet(
    lists: DataFrame, asked: DataFrame, key: str = "term_id", doc: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Join ``lists`` (term_id, doc_id, df, uses) with ``asked`` (qid, term_id and more).

    A list may be long and asked for by many queries. Its documents are dealt over one
    part for each chunk that they would fill, its queries over blocks of a fixed size, and
    every part meets every block in a task of its own. The copies that this takes are a
    small fixed share of the rows that come out.
    """
    parts = F.greatest(F.ceil(F.col("df") / CHUNK_DOCS), F.lit(1)).cast("int")
    groups = F.greatest(F.ceil(F.col("uses") / _ASKED_ROWS), F.lit(1)).cast("int")
    sizes = lists.select(key, "df", "uses").distinct()
    left = lists.select(
        key,
        *doc,
        F.pmod(F.xxhash64(*doc), parts).cast("int").alias("_part"),
        F.explode(F.sequence(F.lit(0), groups - 1)).alias("_group"),
    )
    right = (
        join_weighted(asked, stage(sizes, "asked-sizes"), key, "uses")
        .withColumn("_group", F.pmod(F.xxhash64("qid"), groups).cast("int"))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("df", "uses")
    )
    return left.join(right, [key, "_part", "_group"]).drop("_part", "_group")


def _leads(
    lists: DataFrame, plans: DataFrame, key: str = "term_id", doc: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``plans`` (qid, term_id, df and more) with the documents of their terms' lists.

    Only lists that are some query's rarest are dealt out; all others stay where they are.
    """
    uses = stage(plans.groupBy(key, "df").agg(F.count("*").alias("uses")), "lead-terms")
    return _meet(join_weighted(lists.select(key, *doc), uses, key, "df"), plans.drop("df"), key, doc)


def _by_division(index: TextIndex, batch: ResolvedBatch) -> DataFrame:
    asked = batch.queries.select(
        "qid", F.size("terms").alias("n_terms"), F.explode("terms.term_id").alias("term_id")
    )
    if batch.small:
        lists = index.postings_of(sorted({*batch.lead_ids, *batch.other_ids}))
        found = lists.join(F.broadcast(asked), "term_id")
    else:
        found = _meet(_asked_lists(index, _asked_terms(batch)), asked)
    return (
        found.groupBy("qid", "n_terms", "doc_id")
        .agg(F.count("*").alias("n_found"))
        .filter(F.col("n_found") == F.col("n_terms"))
        .select("qid", "doc_id")
    )


def chunks_holding(index: TextIndex, term_ids: list[int], checks: DataFrame) -> DataFrame:
    """The posting rows of the chunks of ``term_ids`` that some row of ``checks`` falls into.

    ``checks`` has (term_id, doc_id) rows of these terms and is small enough to broadcast,
    or not marked so. They meet what a chunk says of itself, (term_id, chunk, first_doc,
    last_doc), which is read without its payload. Only chunks that span one of the documents
    are then read whole and decoded. A list is in one piece, 0, or cut at documents, and a
    chunk never passes the widest range.
    """
    def reach(doc_id: str) -> Column:
        return whole_div(doc_id, widest_range(index.meta.chunk_docs)) + 1

    pieces = F.array(F.lit(0).cast("bigint"), reach("doc_id"))
    asked = checks.select("term_id", "doc_id", F.explode(pieces).alias("_piece"))
    kept = []
    for stored in index.stored_of(term_ids):
        spans = stored.select("term_id", "chunk", "first_doc", "last_doc")
        met = (
            spans.withColumn("_piece", F.when(F.col("chunk") == 0, 0).otherwise(reach("first_doc")))
            .join(asked, ["term_id", "_piece"])
            .filter("doc_id between first_doc and last_doc")
            .select("term_id", "chunk")
            .distinct()
        )
        kept.append(stored.join(met, ["term_id", "chunk"], "left_semi").select(stored.columns))
    return index.rows(kept)


def _by_rarest(index: TextIndex, batch: ResolvedBatch) -> DataFrame:
    plans = batch.queries.select(
        "qid",
        F.element_at("terms.term_id", 1).alias("term_id"),
        F.element_at("terms.df", 1).alias("df"),
        F.slice("terms.term_id", F.lit(2), F.size("terms")).alias("others"),
    )
    if batch.small:
        leads = index.postings_of(batch.lead_ids).join(F.broadcast(plans), "term_id")
    else:
        asked = _asked_lists(index, _asked_terms(batch)).select("term_id", "doc_id")
        leads = _leads(asked, plans)

    def lists_of(term_ids: list[int], checks: DataFrame) -> DataFrame:
        if not batch.small:
            return asked if known else spread(asked, asked.count(), "term_id", "doc_id")
        if index.meta.codec != "rows":
            return chunks_holding(index, term_ids, checks)
        return index.postings_of(term_ids)

    narrow = not batch.small or batch.check_rows > BROADCAST_ROWS
    if narrow or index.meta.codec != "rows":  # read more than once
        leads = stage(leads.select("qid", "doc_id", "others"), "candidates")
    single = leads.filter(F.size("others") == 0).select("qid", "doc_id")
    paired = leads.filter(F.size("others") > 0)

    def memberships(found: DataFrame) -> int:
        return found.agg(F.coalesce(F.sum(F.size("others")), F.lit(0))).first()[0]

    if not narrow:
        known = True
    elif batch.small:
        known = batch.lead_rows <= BROADCAST_ROWS
    else:
        known = memberships(paired) <= BROADCAST_ROWS
    if narrow:
        # The second shortest list first: what it leaves is what meets the longer ones.
        second = paired.select(
            "qid",
            "doc_id",
            F.element_at("others", 1).alias("term_id"),
            F.slice("others", F.lit(2), F.size("others")).alias("others"),
        )
        if known:
            second = F.broadcast(second)
        left = stage(
            lists_of(batch.second_ids, second)
            .select("term_id", "doc_id")
            .join(second, ["term_id", "doc_id"])
            .select("qid", "doc_id", "others"),
            "narrowed",
        )
        single = single.unionByName(left.filter(F.size("others") == 0).select("qid", "doc_id"))
        paired = left.filter(F.size("others") > 0)
        known = batch.small and memberships(paired) <= BROADCAST_ROWS
    checks = paired.select(
        "qid", "doc_id", F.size("others").alias("n_others"), F.explode("others").alias("term_id")
    )
    if known:
        checks = F.broadcast(checks)
    lists = lists_of(batch.other_ids, checks)
    confirmed = (
        lists.select("term_id", "doc_id")
        .join(checks, ["term_id", "doc_id"])
        .groupBy("qid", "n_others", "doc_id")
        .agg(F.count("*").alias("n_found"))
        .filter(F.col("n_found") == F.col("n_others"))
        .select("qid", "doc_id")
    )
    return single.unionByName(confirmed)


def _set_bits(bits: Column) -> Column:
    """The numbers, from 0, of the bits that are set in a bitmap."""
    # Spelled once for all octets: what a function of an array names is made for each item.
    spelled = F.regexp_extract_all(F.hex(bits), F.lit("[0-9A-F]{2}"), F.lit(0))
    octets = F.transform(
        spelled,
        lambda s, i: F.struct(i.alias("at"), F.conv(s, 16, 10).cast("int").alias("octet")),
    )
    used = F.filter(octets, lambda o: o["octet"] != 0)
    numbers = F.transform(
        used,
        lambda o: F.transform(
            F.filter(
                F.sequence(F.lit(0), F.lit(7)), lambda b: F.call_function("getbit", o["octet"], b) == 1
            ),
            lambda b: o["at"] * 8 + b,
        ),
    )
    return F.flatten(numbers)


def _by_bitmaps(index: TextIndex, batch: ResolvedBatch) -> DataFrame:
    asked = batch.queries.select(
        "qid", F.size("terms").alias("n_terms"), F.explode("terms.term_id").alias("term_id")
    )
    if batch.small:
        rows = index.postings_of(sorted({*batch.lead_ids, *batch.other_ids}))
    else:
        rows = _asked_lists(index, _asked_terms(batch))
    # The functions count bits from 1.
    maps = rows.groupBy(
        "term_id", F.bitmap_bucket_number(F.col("doc_id") + 1).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("doc_id") + 1)).alias("bits"))
    keys = ["term_id"]
    if batch.small:
        asked = F.broadcast(asked)
    else:
        # Bitmaps meet a query only in buckets where it has one for each of its terms.
        keys = ["term_id", "bucket"]
        held = rows.select(
            "term_id", F.bitmap_bucket_number(F.col("doc_id") + 1).alias("bucket")
        ).distinct()
        full = (
            held.join(asked, "term_id")
            .groupBy("qid", "n_terms", "bucket")
            .agg(F.collect_list("term_id").alias("_terms"))
            .filter(F.size("_terms") == F.col("n_terms"))
        )
        asked = stage(
            full.select("qid", "n_terms", "bucket", F.explode("_terms").alias("term_id")), "buckets"
        )
    return (
        maps.join(asked, keys)
        .groupBy("qid", "n_terms", "bucket")
        .agg(F.call_function("bitmap_and_agg", F.col("bits")).alias("bits"), F.count("*").alias("n_found"))
        .filter(F.col("n_found") == F.col("n_terms"))
        .filter(F.bitmap_count("bits") > 0)
        .select(
            "qid",
            ((F.col("bucket") - 1) * _BUCKET_DOCS).alias("first"),
            F.explode(_set_bits(F.col("bits"))).alias("bit"),
        )
        .select("qid", (F.col("first") + F.col("bit")).alias("doc_id"))
    )


def retrieve(index: TextIndex, queries: DataFrame, cap: int = BATCH_ROWS) -> DataFrame:
    """(qid, doc_id, path) of every match; order by (qid, doc_id) for display.

    The document frequencies decide how: a batch of up to ``cap`` (query, token) rows
    whose rarest lists leave too many documents to check by broadcast counts the
    tokens of each document; any other starts from the rarest lists.
    """
    batch = resolve(index.lexicon, queries, cap)
    count = batch.small and batch.check_rows > BROADCAST_ROWS
    hits = _by_division(index, batch) if count else _by_rarest(index, batch)
    return _with_paths(index, batch, hits)


def retrieve_by_division(
    index: TextIndex, queries: DataFrame, cap: int = BATCH_ROWS
) -> DataFrame:
    """The result of ``retrieve``: documents that match as many tokens as there are.

    Each list is read once and every posting of it shuffled.
    """
    batch = resolve(index.lexicon, queries, cap)
    return _with_paths(index, batch, _by_division(index, batch))


def retrieve_rarest_first(
    index: TextIndex, queries: DataFrame, cap: int = BATCH_ROWS
) -> DataFrame:
    """The result of ``retrieve``, from the shortest list of each query up.

    Only documents in the shortest list are candidates, so a query that pairs a
    rare token with stop words does not shuffle the stop words' lists.
    """
    batch = resolve(index.lexicon, queries, cap)
    return _with_paths(index, batch, _by_rarest(index, batch))


def retrieve_by_bitmaps(
    index: TextIndex, queries: DataFrame, cap: int = BATCH_ROWS
) -> DataFrame:
    """The result of ``retrieve``, for queries of stop words alone.

    Each list becomes a bitmap of 4 KB for every 32,768 documents where its rows are read.
    Only bitmaps are shuffled and ANDed; ids are made again from those that are left.
    """
    batch = resolve(index.lexicon, queries, cap)
    return _with_paths(index, batch, _by_bitmaps(index, batch))


def _scanned(documents: DataFrame, words: DataFrame, wanted: DataFrame) -> DataFrame:
    """(qid, block, name) of the matches of ``wanted`` (qid, term, n_terms), which is staged.

    A document is the pair of its names, in which nulls are equal. Words that are not asked for go first, by a join with one row per term. What is left
    is counted by term, so each query starts from the documents of its rarest one; only
    these are asked for the query's terms. Rows of one name count together, as on the path
    for small batches: names that come more than once are asked by each query that shares a
    word with them.
    """
    words = words.select("term", F.struct("block", "name").alias("doc"))
    uses = stage(wanted.groupBy("term").agg(F.count("*").alias("uses")), "scan-uses")
    kept = stage(join_weighted(words, uses, "term", "uses").drop("uses"), "scan-words")
    sizes = stage(kept.groupBy("term").agg(F.count("*").alias("df")).join(uses, "term"), "scan-sizes")
    n_kept = sizes.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    plans = stage(
        join_weighted(wanted, sizes, "term", "uses")
        .groupBy("qid", "n_terms")
        .agg(F.sort_array(F.collect_list(F.struct("df", "term"))).alias("terms")),
        "scan-plans",
    )
    rarest = plans.filter(F.size("terms") == F.col("n_terms")).select(
        "*", F.element_at("terms", 1).alias("at")
    ).select("qid", "n_terms", "terms", "at.*")
    found = _leads(kept, rarest, "term", ["doc"]).select("qid", "doc", "n_terms", "terms")
    names = documents.groupBy(F.struct("block", "name").alias("doc")).count()
    repeated = stage(names.filter("count > 1").select("doc"), "scan-repeated")
    if not repeated.isEmpty():
        each = plans.select("*", F.explode("terms").alias("at"))
        each = each.select("qid", "n_terms", "terms", "at.*")
        again = _leads(kept.join(repeated, "doc", "left_semi"), each, "term", ["doc"])
        found = found.unionByName(again.select(found.columns))
    asked = stage(found.distinct(), "scan-candidates").select(
        "qid", "doc", "n_terms", F.explode("terms.term").alias("term")
    )
    return (
        spread(kept, n_kept, "term", "doc")
        .join(asked, ["term", "doc"])
        .groupBy("qid", "n_terms", "doc")
        .agg(F.count("*").alias("n_found"))
        .filter(F.col("n_found") == F.col("n_terms"))
        .select("qid", "doc.block", "doc.name")
    )


def retrieve_by_scan(
    documents: DataFrame, queries: DataFrame, cap: int = BATCH_ROWS
) -> DataFrame:
    """(qid, path) from the texts themselves, without an index."""
    wanted = query_terms(queries)
    words = documents.select("block", "name", F.explode(distinct_tokens("text")).alias("term"))
    asked = fetch_batch(wanted, cap)
    if asked is not None:
        local = documents.sparkSession.createDataFrame(asked, wanted.schema)
        found = (
            words.join(F.broadcast(local), "term")
            .groupBy("qid", "n_terms", "block", "name")
            .agg(F.count("*").alias("n_found"))
            .filter(F.col("n_found") == F.col("n_terms"))
        )
    else:
        found = _scanned(documents, words, stage(wanted, "scan-terms"))
    return found.select("qid", document_path().alias("path"))


def postings_lookup(index: TextIndex, terms: DataFrame, cap: int = BATCH_ROWS) -> DataFrame:
    """(term, doc_id): the postings of each row of ``terms`` that is indexed."""
    wanted = terms.select("term").distinct()
    asked = fetch_batch(wanted, cap)
    if asked is None:
        entries = index.lexicon.select("term", "term_id", "df")
        known = stage(wanted.join(entries, "term"), "lookup-terms")
        found = join_weighted(index.postings().select("term_id", "doc_id"), known, "term_id", "df")
        return found.select("term", "doc_id")
    spark = index.spark
    found = _known_terms(
        index.lexicon, spark.createDataFrame(asked, wanted.schema), {row.term for row in asked}
    ).select("term", "term_id")
    known = found.collect()
    local = spark.createDataFrame(known, found.schema)
    return (
        index.postings_of(sorted(row.term_id for row in known))
        .join(F.broadcast(local), "term_id")
        .select("term", "doc_id")
    )


def postings_intersect(index: TextIndex, left_id: int, right_id: int) -> DataFrame:
    """(doc_id): the documents in both lists, each once."""
    left = index.postings_of([left_id]).select("doc_id")
    right = index.postings_of([right_id]).select("doc_id")
    return left.join(right, "doc_id", "left_semi")


def terms_intersect(index: TextIndex, left: str, right: str) -> DataFrame:
    """(doc_id): the documents in the lists of both terms; none if one is not indexed.

    The two ids are looked up first, so that they prune the postings scan.
    """
    found = index.lexicon.filter(one_of("term", [left, right])).select("term", "term_id")
    ids = {row.term: row.term_id for row in found.limit(2).collect()}
    if left not in ids or right not in ids:
        return index.postings_of([]).select("doc_id")
    return postings_intersect(index, ids[left], ids[right])
