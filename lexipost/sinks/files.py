"""Corpora, query batches and results as the small text files that the sources read.

A folder is written beside its place and takes the place when all tasks are done. A job
that fails leaves the folder that was there as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from lexipost.sources.folder import filesystem


@dataclass
class _Written(WriterCommitMessage):
    files: int


class _FolderWriter(DataSourceWriter):
    def __init__(self, root: str) -> None:
        self.root = root.rstrip("/")
        self.id = uuid.uuid4().hex

    def _places(self):
        """The file system, the folder, the one that is written and the one set aside."""
        files, base = filesystem(self.root)
        base = base.rstrip("/")
        above, _, name = base.rpartition("/")
        return files, base, f"{above}/.{name}.new-{self.id}", f"{above}/.{name}.old-{self.id}"

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        # A task that is repeated writes the same names again, each as a whole.
        files, _, new, _ = self._places()
        made: set[str] = set()
        now, out, count = None, None, 0
        try:
            for row in iterator:
                if (row.folder, row.name) != now:
                    if out is not None:
                        out.close()
                    folder = f"{new}/{row.folder}".rstrip("/")
                    if folder not in made:
                        files.create_dir(folder, recursive=True)
                        made.add(folder)
                    now, out = (row.folder, row.name), files.open_output_stream(f"{folder}/{row.name}")
                    count += 1
                out.write((row.content or "").encode())
        finally:
            if out is not None:
                out.close()
        return _Written(count)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        files, base, new, old = self._places()
        files.create_dir(new, recursive=True)  # there may have been no row at all
        there = files.get_file_info(base).type != fs.FileType.NotFound
        if there:
            files.move(base, old)
        files.move(new, base)
        if there:
            files.delete_dir(old)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        files, _, new, _ = self._places()
        if files.get_file_info(new).type != fs.FileType.NotFound:
            files.delete_dir(new)


class FolderSink(DataSource):
    """Rows (folder, name, content) as files ``<path>/<folder>/<name>``.

    Rows of one file that follow each other in a partition are its content one after the
    other. A file must not be in two partitions.
    """

    @classmethod
    def name(cls) -> str:
        return "lexipost_folder"

    def schema(self) -> str:
        return "folder string, name string, content string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if not overwrite:
            raise ValueError("a folder is written whole: use the mode 'overwrite'")
        return _FolderWriter(self.options["path"])


def _write(files: DataFrame, root: str) -> None:
    files.sparkSession.dataSource.register(FolderSink)
    rows = files.select("folder", "name", "content")
    rows.write.format(FolderSink.name()).mode("overwrite").option("path", root).save()


def write_corpus(documents: DataFrame, root: str) -> None:
    """``<root>/<block>/<name>`` for each document, in place of what ``root`` holds.

    (block, name) must be a key.
    """
    _write(
        documents.select(F.col("block").alias("folder"), "name", F.col("text").alias("content")), root
    )


def write_queries(queries: DataFrame, root: str) -> None:
    """``<root>/query.<qid>`` for each query, in place of what ``root`` holds."""
    name = F.concat(F.lit("query."), F.col("qid").cast("string")).alias("name")
    _write(queries.select(F.lit("").alias("folder"), name, F.col("query").alias("content")), root)


def write_expected(ranked: DataFrame, queries: DataFrame, root: str) -> None:
    """``<root>/<qid>.out`` for each query, with the paths of ``ranked`` (qid, rank, path).

    The lines of a file, which is one stream of one task, are written in rank order; a
    query without results has an empty file.
    """
    lines = queries.select("qid").distinct().join(ranked.select("qid", "rank", "path"), "qid", "left")
    _write(
        lines.repartition("qid")
        .sortWithinPartitions("qid", "rank")
        .select(
            F.lit("").alias("folder"),
            F.concat(F.col("qid").cast("string"), F.lit(".out")).alias("name"),
            F.concat("path", F.lit("\n")).alias("content"),
        ),
        root,
    )
