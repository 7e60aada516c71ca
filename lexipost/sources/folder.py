"""Small files of any name, read once each: a listing by tasks, then contents by tasks.

Spark's own file sources pass over empty files and over names that start with ``.`` or
``_``; here every file counts. The driver sees neither names nor contents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lexipost import schemas
from lexipost.session import stage

FILES = T.StructType(
    [schemas.MANIFEST[c] for c in ("block", "name", "path")]
    + [T.StructField("content", T.BinaryType())]
)
_NAMED_AT_ONCE = 10_000
_BATCH_BYTES = 8 << 20


def filesystem(root: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def _entries(root: str, folder: str, kind: str) -> Iterator:
    from pyarrow import fs

    files, base = filesystem(root)
    place = f"{base.rstrip('/')}/{folder}".rstrip("/") or "/"
    for info in files.get_file_info(fs.FileSelector(place)):
        if info.type == getattr(fs.FileType, kind):
            yield info


def _records(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator:
    """Record batches of a bounded number of rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _NAMED_AT_ONCE:
            yield _record(held, names, types)
            held = []
    if held:
        yield _record(held, names, types)


def _record(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
    )


def list_folders(spark: SparkSession, root: str) -> DataFrame:
    """(block): the immediate sub-directories of ``root``, listed by one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            found = ((info.base_name,) for info in _entries(root, "", "Directory"))
            yield from _records(found, ["block"], [pa.string()])

    return spark.range(0, 1, 1, 1).mapInArrow(work, "block string")


def list_files(root: str, folders: DataFrame) -> DataFrame:
    """A manifest (block, name, path, size) of the files in each folder (block) of ``root``.

    Each folder is listed by one task, as file systems list a folder from its start.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for block in batch.column("block").to_pylist():
                found = (
                    (block, info.base_name, info.path, info.size)
                    for info in _entries(root, block, "File")
                )
                yield from _records(found, schemas.MANIFEST.names, types)

    return folders.select("block").mapInArrow(work, schemas.MANIFEST)


def read_files(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """(block, name, path, content) of the files of a manifest, each read by one task.

    The staged manifest says how many tasks the bytes need; files are dealt to them at
    random. A record batch holds whole files up to 8 MB, or one larger file.
    """
    listed = stage(manifest.select(*schemas.MANIFEST.names), "manifest")
    total = listed.groupBy().sum("size").first()[0] or 0
    per_task = 64 << 20
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // per_task))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = filesystem(root)
        types = [pa.string(), pa.string(), pa.string(), pa.binary()]
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                content = b""
                if row["size"]:
                    with source.open_input_stream(row["path"]) as stream:
                        content = stream.read()
                if held and size + len(content) > _BATCH_BYTES:
                    yield _record(held, FILES.names, types)
                    held, size = [], 0
                held.append((row["block"], row["name"], row["path"], content))
                size += len(content)
        if held:
            yield _record(held, FILES.names, types)

    return listed.repartition(tasks, "block", "name").mapInArrow(work, FILES)
