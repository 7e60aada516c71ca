"""Document fingerprints by order MinHash.

A text's k-mers (of code points) are numbered by occurrence, so that each is a different
element. Each of the sketches has its own random order of elements, selects the least
ones, puts them back in text order and hashes the tuple of their k-mers. Two texts agree
in a sketch only if they share the selected k-mers in the same order, so the share of
equal sketches falls with the edit distance, also where mere sets of k-mers would agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexipost.llm.arrow import map_batches
from lexipost.llm.superminhash import mix
from lexipost.session import stage

K = 6  # code points of a k-mer
SKETCHES = 32
TUPLE = 2  # k-mers of a sketch
_BLOCK = 1 << 17  # values of the order that are computed at once

_PRIME = np.uint64(0x100000001B3)
_ORDERS = mix(np.arange(1, 2 * SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FLIP = (_ORDERS[:SKETCHES, None] >> np.uint64(32)).astype(np.uint32)
_SPREAD = (_ORDERS[SKETCHES:, None] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _occurrences(kmers: np.ndarray) -> np.ndarray:
    """How many equal k-mers, by all their bits, stand before each one."""
    n = len(kmers)
    order = np.argsort(kmers)
    ordered = kmers[order]
    starts = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    # Equal k-mers go back into text order: quicker than a stable sort of the hashes.
    run = (np.cumsum(starts) - 1) * n
    order += run
    order.sort()
    order -= run
    place = np.arange(n)
    numbers = np.empty(n, np.uint64)
    numbers[order] = place - np.maximum.accumulate(np.where(starts, place, 0))
    return numbers


def fingerprint(text: str) -> np.ndarray:
    """The sketches of a text as unsigned 32-bit integers.

    A text shorter than a k-mer is one k-mer. The empty text has zeros, which (but for
    chance) no other text has.
    """
    if not text:
        return np.zeros(SKETCHES, np.uint32)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = min(K, len(points))
    n = len(points) - size + 1
    kmers = points[:n].copy()
    for k in range(1, size):
        kmers *= _PRIME
        kmers += points[k : n + k]
    kmers = mix(kmers)
    elements = mix(kmers + _occurrences(kmers) * np.uint64(0x9E3779B97F4A7C15))
    ranks = (elements >> np.uint64(32)).astype(np.uint32)  # 32 bits are quick to reorder
    found = np.empty((SKETCHES, min(TUPLE, n)), np.int64)
    rows = max(1, _BLOCK // n)
    for first in range(0, SKETCHES, rows):
        part = slice(first, first + rows)
        values = (ranks ^ _FLIP[part]) * _SPREAD[part]
        at = np.arange(len(values))
        for k in range(found.shape[1]):
            found[part, k] = values.argmin(axis=1)
            values[at, found[part, k]] = np.uint32(0xFFFFFFFF)
    found.sort(axis=1)  # back into text order
    hashed = np.full(SKETCHES, size, np.uint64)
    for k in range(found.shape[1]):
        hashed = mix(hashed * _PRIME + kmers[found[:, k]])
    return (hashed >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal sketches, from 0 to 1; an empty text is like no other."""
    return float((a == b).mean())


def spliced(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COLUMNS = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _described(
    text: str, own: np.ndarray, following: str, next_print: np.ndarray
) -> tuple[int, str, str, str, float, float]:
    edited = spliced(text, following)
    other = own if edited == text else fingerprint(edited)
    return (
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        own.astype(">u4").tobytes().hex(),
        other.astype(">u4").tobytes().hex(),
        likeness(own, other),
        likeness(own, next_print),
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edit, and their likeness.

    The next document is that of descending key order (equal keys by a hash of their
    texts, then by text; null keys last); after the last comes the first, which for one
    document is itself. The edited text is the text with its last half (rounded down)
    replaced by as many code points from the start of the next text, or all it has.
    A null text is an empty one. One row per row of ``docs``: key, n_chars,
    edited_sha256, fingerprint, edited_fingerprint (hex), near_edited, near_next. Other
    columns are left out, whatever their names; an empty table gives no rows.

    Rows are range-partitioned and sorted by key, so neighbours meet in one task, which
    holds two texts and a batch. Each partition also reports its first and last row; the
    last ones, one per partition, are completed from those reports.
    """
    kind = dict(docs.dtypes)[key]
    order = [F.desc_nulls_last("_key"), F.asc("_hash")]
    rows = (
        docs.select(
            F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")
        )
        .withColumn("_hash", F.xxhash64("_text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, F.asc("_text"))
        .withColumn("_part", F.spark_partition_id())
        .drop("_hash")
    )
    columns = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = first = None
        for batch in batches:
            keys = batch.column("_key")
            out: list[tuple] = []
            out_keys: list[object] = []
            for row, content in enumerate(batch.column("_text").to_pylist()):
                own = fingerprint(content)
                if held is None:
                    first = content
                    part = batch.column("_part")[0].as_py()
                else:
                    out_keys.append(held[0])
                    out.append(_described(held[1], held[2], content, own))
                held = (keys[row].as_py(), content, own)
            kept_type = keys.type
            if out:
                yield record(out_keys, kept_type, list(zip(*out, strict=True)))
        if held is not None:
            yield record([held[0]], kept_type, [[None]] * 6, [part], [first], [held[1]])

    def record(keys, kept_type, values, part=None, first=None, last=None) -> pa.RecordBatch:
        empty = [None] * len(keys)
        types = [pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        arrays = [pa.array(keys, kept_type)]
        arrays += [pa.array(v, t) for v, t in zip(values, types, strict=True)]
        arrays += [
            pa.array(part or empty, pa.int32()),
            pa.array(first or empty, pa.string()),
            pa.array(last or empty, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["_key", *columns, "_part", "_first", "_last"])

    described = stage(
        map_batches(rows, work, f"_key {kind}, {_COLUMNS}, _part int, _first string, _last string"),
        "fingerprints",
    )
    # One row per written partition: the window is as small as the list of partitions.
    ends = described.filter(F.col("_part").isNotNull()).select("_key", "_part", "_first", "_last")
    in_order = Window.orderBy("_part")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    joined = ends.select(
        "_key",
        F.col("_last").alias("_text"),
        F.coalesce(F.lead("_first").over(in_order), F.first("_first").over(whole)).alias("_next"),
    )

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, following = (batch.column(c).to_pylist() for c in ("_text", "_next"))
            values = [
                _described(t, fingerprint(t), f, fingerprint(f))
                for t, f in zip(texts, following, strict=True)
            ]
            types = [pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            arrays = [batch.column("_key")]
            arrays += [
                pa.array(v, t)
                for v, t in zip(zip(*values, strict=True) if values else [[]] * 6, types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["_key", *columns])

    last = map_batches(joined, complete, f"_key {kind}, {_COLUMNS}")
    inner = described.filter(F.col("_part").isNull()).select("_key", *columns)
    return inner.unionByName(last).withColumnRenamed("_key", key)
