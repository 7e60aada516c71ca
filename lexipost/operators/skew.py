"""Joins that know which keys are heavy, and query-sized tables of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Most rows that the library takes to the driver.
BATCH_ROWS = 10_000
#: Most rows, of a few bigints each, that it marks for broadcast.
BROADCAST_ROWS = 1_000_000
_HEAVY_KEYS_MAX = 100_000
_TASK_ROWS = 2_000_000  # narrow rows that a task sorts, about


def tasks_for(spark: SparkSession, rows: int) -> int:
    """As many tasks as the session's shuffles have, or more so that ``rows`` fill none.

    What a task sorts then stays in memory however few partitions the session asks for.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // _TASK_ROWS))


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` of about ``rows`` rows, dealt by ``keys`` if the session's shuffles are too few.

    A window or join by these keys that follows adds no shuffle of its own.
    """
    tasks = tasks_for(df.sparkSession, rows)
    if tasks == int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *keys)


def heavy_key_bound(shuffle_partitions: int) -> int:
    """How many heavy keys to allow: four for each shuffle partition.

    A key that is not heavy then holds at most a quarter of an average partition.
    """
    return max(1, min(4 * shuffle_partitions, _HEAVY_KEYS_MAX))


def few_keys(keyed: DataFrame) -> bool:
    """Whether a stored table of one narrow row per key may be marked for broadcast."""
    return keyed.count() <= _HEAVY_KEYS_MAX


def _heavy_floor(classes: list[Row], total: int, bound: int) -> int:
    """The least weight of a heavy key, given (class, keys, rows) by the bits of the weight.

    At most ``bound`` keys weigh a ``bound``th of all rows. The floor is lower if up to
    100,000 keys then spare a quarter of the rows their move, or more.
    """
    floor, keys, rows = -(-total // bound), 0, 0
    for c in sorted((c for c in classes if c["_bits"]), key=lambda c: -c["_bits"]):
        keys, rows = keys + c["_keys"], rows + c["_sum"]
        if keys > _HEAVY_KEYS_MAX:
            break
        if 4 * rows >= total:
            floor = min(floor, 1 << (c["_bits"] - 1))
    return floor


def join_weighted(
    rows: DataFrame, keyed: DataFrame, key: str, weight: str, whole: bool = False
) -> DataFrame:
    """Inner join of ``rows`` with ``keyed``, whose ``weight`` is the rows per key.

    ``keyed`` has one row per key. With a total weight W, at most K keys can weigh
    W/K or more, so the heavy side is at most K rows and safe to broadcast: the
    rows of heavy keys do not move at all. The others are joined by a shuffle in
    which no key holds W/K rows. Up to 100,000 keys, counted, go to the rows as a whole. With ``whole``, every row has its key in ``keyed``: W rows
    then take as many tasks as they ask for, and up to 100,000 of the heaviest keys are
    broadcast where that spares many rows their move.
    """
    classes = keyed.groupBy(F.length(F.bin(weight)).alias("_bits")).agg(
        F.count("*").alias("_keys"), F.sum(weight).alias("_sum"), F.max(weight).alias("_top")
    ).collect()  # by the bits of a weight: 65 rows at most
    if sum(c["_keys"] for c in classes) <= _HEAVY_KEYS_MAX:
        return rows.join(F.broadcast(keyed), key)
    total = sum(c["_sum"] or 0 for c in classes)
    top = max(c["_top"] or 0 for c in classes)
    sorted_rows = total if whole else 0
    bound = heavy_key_bound(tasks_for(rows.sparkSession, sorted_rows))
    floor = _heavy_floor(classes, total, bound) if whole else -(-total // bound)

    def joined(rows: DataFrame, keyed: DataFrame) -> DataFrame:
        return spread(rows, sorted_rows, key).join(spread(keyed, sorted_rows, key), key)

    if top < floor:  # no heavy key: one pass over the rows is enough
        return joined(rows, keyed)
    heavy = keyed.filter(F.col(weight) >= floor)
    light = keyed.filter(F.col(weight) < floor)
    near = rows.join(F.broadcast(heavy), key)
    far = joined(rows.join(F.broadcast(heavy.select(key)), key, "left_anti"), light)
    return near.unionByName(far)


def fetch_batch(df: DataFrame, cap: int = BATCH_ROWS) -> list[Row] | None:
    """The rows of a query-sized table, or None if there are more than ``cap``.

    A longer table must take the shuffle path.
    """
    found = df.limit(cap + 1).collect()
    return None if len(found) > cap else found
