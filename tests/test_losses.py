"""Inputs that must not get lost without a word."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexipost import build_index, open_index, retrieve
from lexipost.operators import codecs
from lexipost.sinks import index as sinks
from lexipost.sinks.results import write_results
from lexipost.sources.batches import read_expected, read_queries
from lexipost.sources.corpus import read_corpus
from lexipost.sources.tables import queries_from_rows

DOCS = [("a", "1", "red blue"), ("a", "2", "blue"), ("b", "1", "")]


def _documents(spark, rows):
    return spark.createDataFrame(rows, "block string, name string, text string")


@pytest.mark.parametrize("more", [(None, "9", "x"), ("c", None, "x"), ("a", "1", "green")])
def test_null_or_repeated_document_keys_fail(spark, tmp_path, more):
    with pytest.raises(Exception, match="a block and a name of its own"):
        build_index(_documents(spark, [*DOCS, more]), f"file://{tmp_path}/index")


@pytest.mark.parametrize("cap", [0, 100])
@pytest.mark.parametrize("rows", [[(1, "red"), (1, "red blue"), (2, "red")], [(None, "red")]])
def test_null_or_repeated_query_ids_fail(spark, tmp_path, rows, cap):
    index = build_index(_documents(spark, DOCS), f"file://{tmp_path}/index")
    with pytest.raises(Exception, match="a qid of its own"):
        retrieve(index, queries_from_rows(spark, rows), cap).collect()


def test_empty_query_files_are_read(spark, tmp_path):
    (tmp_path / "query.1").write_text("red blue\n")
    (tmp_path / "query.2").write_text("")
    (tmp_path / "other").write_text("x")
    rows = read_queries(spark, str(tmp_path)).collect()
    assert sorted((r.qid, r.query) for r in rows) == [(1, "red blue\n"), (2, "")]


def test_blank_lines_of_results_are_kept(spark, tmp_path):
    (tmp_path / "1.out").write_text("a/1\n\n\n")
    (tmp_path / "2.out").write_text("")
    (tmp_path / "3.out").write_text("a/2")
    rows = read_expected(spark, str(tmp_path)).orderBy("qid", "rank").collect()
    assert [(r.qid, r.rank) for r in rows] == [(1, 0), (1, 1), (1, 2), (3, 0)]
    assert (rows[0].path, rows[3].path) == ("a/1", "a/2")


def test_every_query_gets_a_result_file(spark, tmp_path):
    index = build_index(_documents(spark, DOCS), f"file://{tmp_path}/index")
    batch = queries_from_rows(spark, [(1, "blue"), (2, "nosuch"), (3, "")])
    write_results(retrieve(index, batch), f"file://{tmp_path}/results", batch)
    lines = spark.read.schema("path string, qid bigint").text(f"file://{tmp_path}/results")
    assert sorted((r.qid, r.path) for r in lines.collect()) == [
        (1, "a/1"), (1, "a/2"), (2, ""), (3, ""),
    ]


def test_folders_nested_in_a_block_are_left_out(spark, tmp_path):
    root = tmp_path / "corpus"
    (root / "b" / "sub").mkdir(parents=True)
    (root / "b" / "one").write_text("x")
    (root / "b" / "sub" / "deep").write_text("y")
    for form in (str(root), f"file://{root}", f"{root}/"):
        rows = read_corpus(spark, form).collect()
        assert [(r.block, r.name, r.text) for r in rows] == [("b", "one", "x")]


@pytest.mark.parametrize("chunk", [1, 3, 50])
def test_gamma_chunks_join_to_the_whole_list(spark, chunk):
    """Wherever a list is cut, the joined payloads and the decoded ids stay the same."""
    ids = [0, 1, 2, 3, 9, 10, 400, 401, 402, 403, 404, 405, 406, 407, 5_000, 99_999, 100_000]
    whole = spark.createDataFrame([(1, 0, i) for i in ids], "term_id bigint, chunk bigint, doc_id bigint")
    place = F.row_number().over(Window.partitionBy("term_id").orderBy("doc_id"))
    cut = whole.withColumn("chunk", (F.floor(place / chunk) + 1).cast("bigint"))
    want = codecs.encode(whole, "gamma").first().payload
    parts = codecs.encode(cut, "gamma")
    assert "".join(r.payload for r in parts.orderBy("chunk").collect()) == want
    assert sorted(r.doc_id for r in codecs.decode(parts, "gamma").collect()) == ids


def test_a_failed_build_leaves_the_index_as_it_was(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/index"
    build_index(_documents(spark, DOCS), path)

    def broken(*args):
        raise OSError("no space")

    monkeypatch.setattr(sinks, "write_postings", broken)
    with pytest.raises(OSError):
        build_index(_documents(spark, [("z", "1", "blue green")]), path)
    found = retrieve(open_index(spark, path), queries_from_rows(spark, [(1, "blue")]))
    assert sorted(r.path for r in found.collect()) == ["a/1", "a/2"]
