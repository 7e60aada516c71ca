"""A boolean text index built, compressed and queried with Spark."""

from lexipost.plans.index import (
    TextIndex,
    build_index,
    compact_index,
    extend_index,
    merge_indexes,
    open_index,
)
from lexipost.operators.retrieval import retrieve, retrieve_by_scan, retrieve_rarest_first

__all__ = [
    "TextIndex",
    "build_index",
    "compact_index",
    "extend_index",
    "merge_indexes",
    "open_index",
    "retrieve",
    "retrieve_by_scan",
    "retrieve_rarest_first",
]
