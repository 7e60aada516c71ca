"""Connected components by alternating large and small stars.

Each step hangs neighbours onto the least node of their neighbourhood: a large star moves
the larger neighbours of every node, a small star the smaller ones. The edges become one
star per component after about log(n) rounds. A node's neighbours are never gathered:
the least one is an aggregate, and each edge is rewritten by a join with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexipost.session import stage

MAX_ROUNDS = 100  # far above what any graph needs; reaching it is an error
ROWS_PER_FILE = 50_000


def narrow(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has about ``rows`` small rows, in no more partitions than they need.

    A table of pairs or labels is small beside the corpus that it came from, whose number
    of shuffle partitions would leave next to nothing in each.
    """
    return df.coalesce(max(8, rows // ROWS_PER_FILE))


def _least(edges: DataFrame, rows: int, label: str) -> DataFrame:
    # Staged, so that the join with it has two plain shuffles and a hub can be split.
    return stage(narrow(edges.groupBy("u").agg(F.min("v").alias("m")), rows), label)


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, 2 * rows, "large-star").select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    least = _least(edges, rows, "small-star")
    moved = (
        edges.join(least, "u")
        .filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one node, which hangs on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(
        edges.select("v", F.lit(0)).distinct()
    )
    return (
        ends.groupBy("node")
        .agg(F.sum("up").alias("up"), F.min("up").alias("least"))
        .filter("up > 1 or (up > 0 and least = 0)")
        .isEmpty()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b).

    ``component`` is the least node reachable. Edges may repeat, run either way, or join a
    node with itself; those with a null end are passed over. Every round is written to
    the staging folder.
    """
    straight = edges.dropna(subset=["a", "b"])
    alone = straight.filter("a = b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    current = stage(
        straight.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    rows = current.count()
    for _ in range(MAX_ROUNDS):
        if _is_settled(current):
            break
        stars = stage(narrow(_large_star(current, rows), rows), "stars")
        current = stage(narrow(_small_star(stars, rows), rows), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("u"), "v")
    return narrow(
        current.unionByName(roots)
        .unionByName(alone)
        .groupBy(F.col("u").alias("node"))
        .agg(F.min("v").alias("component")),
        rows,
    )
