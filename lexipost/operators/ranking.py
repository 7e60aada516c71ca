"""Dense ids, ranks and running totals without a one-task window.

A window with no partition key sends every row to one task. The functions here
rank inside bounded pieces and add the offset of each piece; only the table of
pieces, which is smaller by the size of a piece, is ever windowed as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexipost.functions.numbers import whole_div
from lexipost.session import stage

_IN_PARTITION_BITS = 33  # low bits of monotonically_increasing_id()
PIECE_ROWS = 1 << 16


def _exclusive_total(value: str, *, by: Sequence[str] = (), order: str) -> Column:
    """Sum of ``value`` over the rows before this one, 0 for the first."""
    earlier = (
        Window.partitionBy(*by)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def dense_ids(df: DataFrame, keys: Sequence[str], id_col: str, first: int = 0) -> DataFrame:
    """Add ``id_col``: the rank of each row by ``keys``, counted from ``first``.

    ``keys`` must be unique. One range shuffle sorts the rows, which are then
    staged with their partition number and place; a partition's offset is the row
    count of those before it. The offsets are one row per written partition, which
    bounds the broadcast.
    """
    runs = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_run", F.spark_partition_id())
        .withColumn(
            "_at",
            F.monotonically_increasing_id().bitwiseAND((1 << _IN_PARTITION_BITS) - 1),
        ),
        f"{id_col}-runs",
    )
    sizes = runs.groupBy("_run").agg(F.count("*").alias("_rows"))
    offsets = sizes.select(
        "_run", (_exclusive_total("_rows", order="_run") + first).alias("_offset")
    )
    return runs.join(F.broadcast(offsets), "_run").select(
        (F.col("_offset") + F.col("_at")).cast("bigint").alias(id_col), *df.columns
    )


def exclusive_totals(
    df: DataFrame,
    dense_key: str,
    totals: dict[str, str],
    piece: int = PIECE_ROWS,
) -> DataFrame:
    """Add running totals in ``dense_key`` order, each without its own row.

    ``totals`` maps a value column to the name of its total. ``dense_key`` is a
    dense id, so a piece holds at most ``piece`` rows. ``df`` feeds both the sums of
    the pieces and their rows, and is staged so that it is computed once.
    """
    staged = stage(df, "totals")
    pieces = staged.withColumn("_piece", whole_div(dense_key, piece))
    sums = pieces.groupBy("_piece").agg(
        *[F.sum(value).alias(f"_sum_{total}") for value, total in totals.items()]
    )
    starts = sums.select(
        "_piece",
        *[
            _exclusive_total(f"_sum_{total}", order="_piece").alias(f"_start_{total}")
            for total in totals.values()
        ],
    )
    return (
        pieces.join(starts, "_piece")
        .select(
            *df.columns,
            *[
                (
                    F.col(f"_start_{total}")
                    + _exclusive_total(value, by=["_piece"], order=dense_key)
                )
                .cast("bigint")
                .alias(total)
                for value, total in totals.items()
            ],
        )
    )


def rank_in_group(
    df: DataFrame, group: str, order: str, rank_col: str = "rank", piece: int = PIECE_ROWS
) -> DataFrame:
    """Add the 0-based rank by ``order`` (a unique bigint id) inside each ``group``.

    A group may hold most of the rows, so it is ranked in pieces of the id range.
    ``df`` is staged, because the sizes of the pieces come first.
    """
    pieces = stage(df, "ranked").withColumn("_piece", whole_div(order, piece))
    sizes = pieces.groupBy(group, "_piece").agg(F.count("*").alias("_rows"))
    starts = sizes.select(
        group, "_piece", _exclusive_total("_rows", by=[group], order="_piece").alias("_start")
    )
    inside = Window.partitionBy(group, "_piece").orderBy(order)
    return pieces.join(starts, [group, "_piece"]).select(
        *df.columns,
        (F.col("_start") + F.row_number().over(inside) - 1).cast("bigint").alias(rank_col),
    )
