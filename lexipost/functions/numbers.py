"""Column expressions over whole numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(value: Column | str, by: int) -> Column:
    """Bigint division that drops the rest, without passing through a double."""
    return F.call_function("div", F.col(value) if isinstance(value, str) else value, F.lit(by))
