"""Mixing sources to target weights by Pfair scheduling.

A source's documents are cut into blocks of text. One slot of the mixture takes one
block. The ideal mixture gives every source that has text left its weight's part of each
slot; when a source runs out the others go on in their proportions. A block may not come
before the slot in which the ideal begins it and is due by the slot in which the ideal
ends it. Taking the earliest deadline first meets every window, which means that after any
number of slots each source is less than one block from the ideal.

Weights are used as they are. With ``weight`` w, block i (from 0) of a source begins at
i / w and ends at (i + 1) / w of a common clock, which runs by the sum of the weights that
are live; slots follow from the clock by a piecewise linear map.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexipost.llm.arrow import map_batches
from lexipost.session import stage

BLOCK_CHARS = 1 << 18
SLOT_ROWS = 1 << 16  # of the schedule that are written at a time
_ROUNDING = 1e-9  # of a slot number, relative: what double precision may add


def scheduled(
    sources: list[tuple[str, int, float]],
) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) in slot order of (source, blocks, weight).

    Blocks and weights are above 0. Takes memory by the sources, not by the blocks.
    """
    ends = sorted((n / w, n, w) for _, n, w in sources)
    clock = [e for e, _, _ in ends]
    gone, live = [0], [0.0]  # blocks of the ended sources, weight of the others
    for _, n, _ in ends:
        gone.append(gone[-1] + n)
    for _, _, w in reversed(ends):
        live.append(live[-1] + w)
    live.reverse()

    def slots_at(time: float) -> float:
        at = bisect_right(clock, time)
        return gone[at] + live[at] * time

    def window(weight: float, number: int) -> tuple[int, int]:
        begin, end = slots_at(number / weight), slots_at((number + 1) / weight)
        begin += _ROUNDING * max(1.0, begin)
        end -= _ROUNDING * max(1.0, end)
        return math.floor(begin), math.ceil(end)

    # (release, deadline, source's place, block): one at most of each source in both heaps.
    by_name = sorted(sources)
    later = [(*window(w, 0), i, 0) for i, (_, _, w) in enumerate(by_name)]
    heapq.heapify(later)
    ready: list[tuple[int, int, int, int]] = []
    slot = 0
    while later or ready:
        while later and later[0][0] <= slot:
            release, deadline, i, number = heapq.heappop(later)
            heapq.heappush(ready, (deadline, i, number, release))
        if not ready:  # by rounding alone: no slot stays free
            release, deadline, i, number = heapq.heappop(later)
            heapq.heappush(ready, (deadline, i, number, release))
        deadline, i, number, release = heapq.heappop(ready)
        name, blocks, weight = by_name[i]
        yield name, number, release, deadline, slot
        slot += 1
        if number + 1 < blocks:
            heapq.heappush(later, (*window(weight, number + 1), i, number + 1))


def _placed(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(_key, _source, _chars, _run, _inside): chars before each row in its sorted run."""
    rows = (
        docs.select(
            F.col(key).alias("_key"),
            F.col(source).cast("string").alias("_source"),
            F.coalesce(F.length(F.col(text).cast("string")), F.lit(0)).cast("bigint").alias("_chars"),
        )
        .repartitionByRange("_source", "_key", "_chars")
        .sortWithinPartitions("_source", "_key", "_chars")
        .withColumn("_run", F.spark_partition_id())
    )
    kind = dict(rows.dtypes)["_key"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = object(), 0
        for batch in batches:
            before = []
            for s, n in zip(
                batch.column("_source").to_pylist(), batch.column("_chars").to_pylist(), strict=True
            ):
                if s != now:
                    now, total = s, 0
                before.append(total)
                total += n
            arrays = [*batch.columns, pa.array(before, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "_inside"])

    return map_batches(
        rows, work, f"_key {kind}, _source string, _chars bigint, _run int, _inside bigint"
    )


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    exponent: float = 0.5,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The place of every document in the mixture.

    One row (key, source, block, release, deadline, slot) per row of ``docs``. ``block``
    is the number, from 0, of the block in which the document starts when the source's
    documents follow each other by key, and ``slot`` the block's place in the mixture.
    Slots from ``release`` on and before ``deadline`` are the block's window. Documents of
    one block follow each other by key. No document is left out or repeated.

    ``weights`` are the target weights by source; by default each source weighs its text
    to the power ``exponent``. Sources without a weight, and rows without a source, come
    after all others, block by block; their window is null. A null text has no length.
    Equal keys are ordered by length. An empty table gives no rows. Other columns are
    left out, whatever their names.

    Documents are sorted once, without their texts; totals are per sorted run. One task
    deals the slots: it reads one row per weighted source and writes one per block, with
    memory by the sources.
    """
    spark = docs.sparkSession
    rows = stage(_placed(docs, key, source, text), "mixing-runs")
    sums = rows.groupBy("_run", "_source").agg(F.sum("_chars").alias("_sum"))
    # Rows here are one per sorted run and source: as few as the partitions and sources.
    earlier = Window.partitionBy("_source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(
        sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))), "mixing-sums"
    )
    totals = runs.filter(F.col("_source").isNotNull()).groupBy("_source").agg(F.sum("_sum").alias("n"))
    blocks_of = F.greatest(F.expr(f"cast(ceil(n / {block_chars}) as bigint)"), F.lit(1))
    if weights is None:
        weighted = totals.withColumn("_weight", F.pow("n", F.lit(float(exponent))))
    else:
        rows_of = [(s, float(w)) for s, w in weights.items() if w and w > 0]
        weighted = totals.join(
            spark.createDataFrame(rows_of, "_source string, _weight double"), "_source"
        )
    weighted = stage(
        weighted.filter("_weight > 0").select("_source", blocks_of.alias("_blocks"), "_weight"),
        "mixing-weights",
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
        dealt = scheduled(sources)
        while part := list(islice(dealt, SLOT_ROWS)):
            names, *numbers = zip(*part, strict=True)
            arrays = [pa.array(names, pa.string()), *[pa.array(n, pa.int64()) for n in numbers]]
            yield pa.RecordBatch.from_arrays(
                arrays, ["_source", "block", "release", "deadline", "slot"]
            )

    # One task, as each slot depends on the one before; its input is a row per source.
    slots = stage(
        map_batches(
            weighted.repartition(1),
            work,
            "_source string, block bigint, release bigint, deadline bigint, slot bigint",
        ),
        "mixing-slots",
    )
    end = weighted.agg(F.coalesce(F.sum("_blocks"), F.lit(0))).first()[0]
    whole = Window.partitionBy("_source")
    before = runs.withColumn("n", F.sum("_sum").over(whole)).select(
        "_run", "_source", "_before", (blocks_of - 1).alias("_last")
    )
    placed = rows.join(
        before, (rows["_run"] == before["_run"]) & rows["_source"].eqNullSafe(before["_source"])
    ).select(
        "_key",
        rows["_source"],
        # A text of no length at the very end of a source stays in its last block.
        F.least(F.expr(f"(_before + _inside) div {block_chars}"), "_last").alias("block"),
    )
    return placed.join(slots, ["_source", "block"], "left").select(
        F.col("_key").alias(key),
        F.col("_source").alias(source),
        "block",
        "release",
        "deadline",
        F.coalesce("slot", F.lit(end) + F.col("block")).alias("slot"),
    )


def _unused(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it; Spark's names do not tell case."""
    lower = {t.lower() for t in taken}
    while name in lower:
        name += "_"
    return name


def mixed(docs: DataFrame, slots: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, sorted over its partitions by slot, then key.

    Rows of equal keys share the earliest slot; null keys come last.
    """
    key_name, slot_name = (_unused(name, docs.columns) for name in ("_key", "_slot"))
    order = slots.groupBy(F.col(key).alias(key_name)).agg(F.min("slot").alias(slot_name))
    by = [F.asc_nulls_last(slot_name), F.asc(key)]
    return (
        docs.join(order, F.col(key) == F.col(key_name), "left")
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(*docs.columns)
    )
