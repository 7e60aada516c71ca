"""Whole-table jobs that encode and decode postings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexipost.functions import codes
from lexipost.operators.gaps import chunk_marks, gaps_to_postings
from lexipost.operators.inversion import posting_lists
from lexipost.operators.skew import spread
from lexipost.session import stage


_SHARED_BITS = 7  # most bits of a byte that may belong to later chunks


def _id_lists(postings: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(term_id, chunk, doc_ids, *keep) with what no code can hold turned away.

    A chunk is one array of ids, so that one shuffle of ids finds them together and
    neither gaps nor codes are sorted or shuffled.
    """
    doc_id = F.col("doc_id")
    checked = F.when(doc_id >= 0, doc_id).otherwise(_refused())
    return posting_lists(postings.select("term_id", "chunk", checked.alias("doc_id"), *keep), keep)


def _refused() -> Column:
    return F.raise_error(F.lit("postings must be distinct and not negative")).cast("bigint")


def _gap(doc_id: Column, before: Column) -> Column:
    return F.when(doc_id > before, doc_id - before).otherwise(_refused())


def _later_gaps(ids: Column) -> Column:
    """The gaps of a chunk but its first, which is measured from the chunk before."""
    before = F.slice(ids, F.lit(1), F.size(ids) - 1)
    return F.zip_with(F.slice(ids, F.lit(2), F.size(ids)), before, _gap)


def _joined(values: Column, code: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(values, code), "")


def _gap_chunks(postings: DataFrame, codec: str, keep: Sequence[str]) -> DataFrame:
    """Chunks of gap codes; the first gap of a list is from the base of its codec.

    Chunks are staged with the codes of all gaps but their first. What that is measured
    from is the last id of the chunk before: the window of a list sees the ends of its
    chunks and never a payload, and only lists that were cut pass it.
    """
    start, code = (
        (codes.VB_BASE, codes.vb_code) if codec == "vb" else (codes.GAMMA_BASE, codes.gamma_code)
    )
    chunks = stage(
        _id_lists(postings, keep)
        .select(
            "term_id",
            "chunk",
            F.size("doc_ids").cast("bigint").alias("n_postings"),
            F.element_at("doc_ids", 1).alias("first_doc"),
            F.element_at("doc_ids", -1).alias("last_doc"),
            _joined(_later_gaps(F.col("doc_ids")), code).alias("payload"),
            *keep,
        )
        .withColumn("_bits", F.length("payload"))
        .withColumn("_head", F.substring("payload", 1, _SHARED_BITS)),
        "gap-chunks",
    )
    columns = [
        "term_id", "chunk", "base", "n_postings", "first_doc", "last_doc", "lead", "payload", *keep,
    ]
    first = code(F.col("first_doc") - start)
    whole = chunks.filter("chunk = 0").select(
        "*",
        F.lit(start).cast("bigint").alias("base"),
        F.lit("").alias("lead"),
        F.concat(first, "payload").alias("_code"),
    )
    cut = chunks.filter("chunk > 0")
    in_list = Window.partitionBy("term_id").orderBy("chunk")
    ends = cut.select(
        "term_id",
        "chunk",
        "first_doc",
        F.lag("last_doc").over(in_list).alias("_prev"),
        "_bits",
        "_head",
    )
    gap = F.when(F.col("_prev").isNull(), F.col("first_doc") - start).otherwise(
        _gap(F.col("first_doc"), F.col("_prev"))
    )
    ends = ends.withColumn("_first", code(gap)).withColumn(
        "base", F.coalesce("_prev", F.lit(start).cast("bigint"))
    )
    if codec == "vb":
        seams = ends.select("term_id", "chunk", "base", "_first")
        placed = cut.join(seams, ["term_id", "chunk"]).select(
            "*", F.lit("").alias("lead"), F.concat("_first", "payload").alias("_code")
        )
        rows = whole.drop("payload").withColumnRenamed("_code", "payload").select(columns)
        return rows.unionByName(
            placed.drop("payload").withColumnRenamed("_code", "payload").select(columns)
        )
    whole = whole.withColumn("payload", codes.bits_to_hex(F.col("_code"))).select(columns)
    return whole.unionByName(_gamma_payloads(cut, ends, keep).select(columns))


def _gamma_payloads(cut: DataFrame, ends: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Chunks of long lists with their bits to hex.

    The bits of a list run on over its chunks. A chunk owns the bytes whose first bit it
    holds, and completes its last byte from the chunks after it; at least one bit stands
    in each, so seven are enough. Only the end of the list is filled up. The window of a
    list sees a length and seven bits of each chunk; payloads meet what it found chunk by
    chunk.
    """
    in_list = Window.partitionBy("term_id").orderBy("chunk")
    ends = ends.withColumn("_bits", F.col("_bits") + F.length("_first")).withColumn(
        "_head", F.substring(F.concat("_first", "_head"), 1, _SHARED_BITS)
    )
    before = F.sum("_bits").over(in_list.rowsBetween(Window.unboundedPreceding, -1))
    later = [F.lead("_head", k).over(in_list) for k in range(1, _SHARED_BITS + 1)]
    seams = ends.select(
        "term_id",
        "chunk",
        "base",
        "_first",
        F.pmod(-F.coalesce(before, F.lit(0)), F.lit(8)).cast("int").alias("_shared"),
        F.concat_ws("", *later).alias("_later"),
    )
    placed = cut.join(seams, ["term_id", "chunk"]).withColumn(
        "_code", F.concat("_first", "payload")
    )
    own = F.substring("_code", F.col("_shared") + 1, F.length("_code"))
    missing = F.when(own == "", 0).otherwise(F.pmod(-F.length(own), F.lit(8)))
    full = F.concat(own, F.substring(F.col("_later"), F.lit(1), missing))
    return placed.select(
        "term_id",
        "chunk",
        "base",
        "n_postings",
        "first_doc",
        "last_doc",
        F.substring("_code", F.lit(1), F.col("_shared")).alias("lead"),
        codes.bits_to_hex(full).alias("payload"),
        *keep,
    )


def encode(postings: DataFrame, codec: str, keep: Sequence[str] = ()) -> DataFrame:
    """Encoded chunks (term_id, chunk, base, n_postings, first_doc, last_doc, lead, payload as hex).

    ``base`` is the id that the first gap is measured from: the last id of the
    chunk before. The payloads of a list, joined in chunk order, are the payload of the
    whole list. Gamma codes do not end at bytes: ``lead`` repeats the bits of a chunk
    that stand in the last byte of the chunk before, so that a chunk can be decoded alone.
    ``keep`` names columns that have one value in a list; the chunks take them along.
    """
    codes.check_codec(codec)
    if codec != "raw":
        return _gap_chunks(postings, codec, keep)
    return posting_lists(postings, keep).select(
        "term_id",
        "chunk",
        F.lit(0).cast("bigint").alias("base"),
        F.size("doc_ids").cast("bigint").alias("n_postings"),
        F.element_at("doc_ids", 1).alias("first_doc"),
        F.element_at("doc_ids", -1).alias("last_doc"),
        F.lit("").alias("lead"),
        _joined(F.col("doc_ids"), codes.raw_code).alias("payload"),
        *keep,
    )


def decode(encoded: DataFrame, codec: str, n_postings: int = 0) -> DataFrame:
    """Posting rows (term_id, chunk, doc_id) of encoded chunks.

    The still encoded chunks are what gets shuffled; the running sum then finds
    the rows of a chunk together already. ``n_postings``, if known, tells how many tasks
    that takes.
    """
    codes.check_codec(codec)
    forms = codes.split_payload(F.col("payload"), codec, F.col("lead"), F.col("n_postings"))
    if codec == "raw":
        return encoded.select(
            "term_id", "chunk", F.explode(forms).alias("code")
        ).select("term_id", "chunk", codes.raw_value(F.col("code")).alias("doc_id"))
    value = codes.vb_value if codec == "vb" else codes.gamma_value
    gapped = (
        spread(encoded.repartition("term_id", "chunk"), n_postings, "term_id", "chunk")
        .select(
            "term_id",
            "chunk",
            "base",
            F.posexplode(forms).alias("pos", "code"),
        )
        .select("term_id", "chunk", "base", "pos", value(F.col("code")).alias("gap"))
    )
    return gaps_to_postings(gapped)


def _coded(values: Column, codec: str) -> Column:
    """The payload, in hex, of an array of ids (raw) or gaps."""
    code = {"raw": codes.raw_code, "vb": codes.vb_code, "gamma": codes.gamma_code}[codec]
    joined = F.array_join(F.transform(values, code), "")
    return codes.bits_to_hex(joined) if codec == "gamma" else joined


def _decoded(payload: Column, codec: str, count: Column) -> Column:
    value = {"raw": codes.raw_value, "vb": codes.vb_value, "gamma": codes.gamma_value}[codec]
    return F.transform(codes.split_payload(payload, codec, F.lit(""), count), value)


def round_trip(postings: DataFrame) -> DataFrame:
    """Per codec, the postings and how many differ after encoding and decoding.

    Every chunk becomes one array of ids, by one shuffle in which what its first gap is
    measured from travels as a row of its own; the three codecs are applied to it, undone
    and compared inside the row. What the codes hold is compared: ids for raw, gaps for
    the others, each chunk coded by itself.
    """
    none = F.lit(None).cast("bigint")
    doc_id = F.col("doc_id")
    checked = F.when(doc_id >= 0, doc_id).otherwise(_refused()).alias("doc_id")
    rows = postings.select("term_id", "chunk", checked, none.alias("prev"))
    marks = chunk_marks(postings).select(
        "term_id", "chunk", none.alias("doc_id"), F.col("doc_id").alias("prev")
    )
    lists = (
        rows.unionByName(marks)
        .groupBy("term_id", "chunk")
        .agg(F.sort_array(F.collect_list("doc_id")).alias("raw"), F.max("prev").alias("prev"))
        .withColumn("n", F.size("raw"))
    )
    first = F.element_at("raw", 1)

    def gapped(base: int) -> Column:
        start = F.when(F.col("prev").isNull(), first - base).otherwise(_gap(first, F.col("prev")))
        return F.concat(F.array(start), _later_gaps(F.col("raw")))

    values = {"raw": F.col("raw"), "vb": gapped(codes.VB_BASE), "gamma": gapped(codes.GAMMA_BASE)}
    arrays = lists.select("n", *[v.alias(c) for c, v in values.items()])
    coded = arrays.select("*", *[_coded(F.col(c), c).alias(f"{c}_payload") for c in codes.CODECS])
    wrong = [
        F.size(
            F.filter(
                F.zip_with(
                    c, _decoded(F.col(f"{c}_payload"), c, F.col("n")), lambda x, y: ~x.eqNullSafe(y)
                ),
                lambda differs: differs,
            )
        ).alias(c)
        for c in codes.CODECS
    ]
    totals = coded.select("n", *wrong).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_postings"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in codes.CODECS],
    )
    audits = [F.struct(F.lit(c).alias("codec"), F.col(c).alias("wrong")) for c in codes.CODECS]
    return totals.select("n_postings", F.explode(F.array(*audits)).alias("audit")).select(
        "audit.codec", "n_postings", F.col("audit.wrong").alias("n_mismatches")
    )
