"""Corpus directories: ``<root>/<block>/<file>``, one UTF-8 text per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexipost.session import stage
from lexipost.sources.folder import list_files, list_folders, read_files


def list_corpus(spark: SparkSession, root: str) -> DataFrame:
    """A manifest (block, name, path, size) of every file one level below ``root``.

    Files in ``root`` itself and in folders below the blocks are ignored.
    """
    return list_files(root, list_folders(spark, root).repartition("block"))


def _checked_text(content: Column, path: Column) -> Column:
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(
        F.raise_error(F.concat(F.lit("not UTF-8: "), path))
    )


def read_corpus(
    spark: SparkSession, root: str, manifest: DataFrame | None = None
) -> DataFrame:
    """Documents (block, name, text) of a corpus directory, in a staged table.

    Every file is read once, in the one pass that writes the table; a build, which reads
    names and texts at different times, then reads columns and no small files. Empty files
    and hidden names are documents like any other, because one that went missing would
    shift all later ids. Bytes that are not UTF-8 fail the job. ``manifest`` is by default
    ``list_corpus``.
    """
    if manifest is None:
        manifest = list_corpus(spark, root)
    contents = read_files(spark, root, manifest)
    return stage(
        contents.select(
            "block", "name", _checked_text(F.col("content"), F.col("path")).alias("text")
        ),
        "corpus",
    )
