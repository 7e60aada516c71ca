"""Arrow batches of bounded size between Spark and Python functions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes that Spark puts into one Arrow batch at most. A batch holds one row
#: at least, so a task's memory is bounded by these and by the longest text.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limits for Arrow batches to those above."""
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(key).lower()).groups()
        now = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with bounded batches."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(function, schema)


def gathered(
    batches: Iterator[pa.RecordBatch], text: str, chars: int
) -> Iterator[pa.RecordBatch]:
    """Join consecutive batches until their ``text`` columns hold ``chars`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= chars:
            yield pa.concat_batches(held) if len(held) > 1 else held[0]
            held, size = [], 0
    if held:
        yield pa.concat_batches(held) if len(held) > 1 else held[0]
