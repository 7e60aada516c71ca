"""Comparison of two sets of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_difference(
    left: DataFrame, right: DataFrame, on: Sequence[str], keep_equal: bool = False
) -> DataFrame:
    """Rows that only one side has, with ``side`` naming it ('left' or 'right').

    Both directions come from one aggregation by the row, so from one shuffle.
    With ``keep_equal`` the shared rows stay, as side 'both'.
    """
    both = left.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    sides = both.groupBy(*on).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    if not keep_equal:
        sides = sides.filter(F.col("_l") != F.col("_r"))
    side = F.when(F.col("_r") == 0, "left").when(F.col("_l") == 0, "right").otherwise("both")
    return sides.select(*on, side.alias("side"))


def _aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """The ranked lines of both sides next to each other.

    (qid, rank) is unique on each side, so even a query that returns most of the
    collection spreads over all partitions.
    """
    ours = left.select("qid", "rank", F.col("path").alias("left_path"))
    theirs = right.select("qid", "rank", F.col("path").alias("right_path"))
    return ours.join(theirs, ["qid", "rank"], "full_outer")


def validate(queries: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(qid, n_left, n_right, passed): are the ordered lists of a query equal?

    ``left`` and ``right`` are (qid, rank, path). A query without results on
    either side passes.
    """
    verdicts = (
        _aligned(left, right)
        .groupBy("qid")
        .agg(
            F.count("left_path").alias("n_left"),
            F.count("right_path").alias("n_right"),
            F.bool_and(F.col("left_path").eqNullSafe(F.col("right_path"))).alias("passed"),
        )
    )
    return queries.select("qid").join(verdicts, "qid", "left").select(
        "qid",
        F.coalesce("n_left", F.lit(0)).cast("bigint").alias("n_left"),
        F.coalesce("n_right", F.lit(0)).cast("bigint").alias("n_right"),
        F.coalesce("passed", F.lit(True)).alias("passed"),
    )


def first_mismatch(left: DataFrame, right: DataFrame) -> DataFrame:
    """(qid, rank, left_path, right_path) of the first line that differs per query."""
    return (
        _aligned(left, right)
        .filter(~F.col("left_path").eqNullSafe(F.col("right_path")))
        .groupBy("qid")
        .agg(
            F.min("rank").alias("rank"),
            F.min_by("left_path", "rank").alias("left_path"),
            F.min_by("right_path", "rank").alias("right_path"),
        )
    )
