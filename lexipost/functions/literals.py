"""Lists of values as filters that reach the row groups of a Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence

# Spark hands a longer list to Parquet as its least and greatest value alone.
_PUSHED = 10
MOST_LITERALS = 256


def _text(value: int | str) -> str:
    if isinstance(value, int):
        return f"{value:d}L"
    # In hex, so that no character of the value can end the text.
    return f"cast(x'{value.encode('utf-8').hex()}' as string)"


def one_of(column: str, values: Sequence[int] | Sequence[str]) -> str:
    """SQL for ``column in (values)``.

    A list of up to 256 values is said in short lists, which statistics, column indexes
    and Bloom filters of the files can all answer. A longer one would skip little, and
    is a set that each row is looked up in once.
    """
    if not values:
        return "false"
    size = _PUSHED if len(values) <= MOST_LITERALS else len(values)
    parts = [values[i : i + size] for i in range(0, len(values), size)]
    return " or ".join(f"{column} in ({', '.join(map(_text, part))})" for part in parts)
