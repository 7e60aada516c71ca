import os

import pytest
from pyspark.sql import functions as F

import toy
from lexipost import build_index, open_index, retrieve
from lexipost.operators import compare
from lexipost.operators.ranking import rank_in_group
from lexipost.session import new_stage_path
from lexipost.sinks.files import write_corpus, write_expected
from lexipost.sinks.results import write_results
from lexipost.sources.batches import read_expected, read_queries
from lexipost.sources.corpus import list_corpus, read_corpus


def _write(root, rows):
    for block, name, text in rows:
        folder = root / block
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(text.encode("utf-8"))


AWKWARD = [
    *toy.MIXED,
    ("2", "_hidden", "hidden words"),
    ("2", ".dotted", "dotted words"),
    ("2", ".nothing", ""),
    ("2", "with space+plus%20", "spaced alpha"),
    ("2", "ünïcode", "é alpha"),
]


def test_corpus_directory(spark, tmp_path):
    _write(tmp_path, AWKWARD)
    (tmp_path / "readme").write_text("not in a block")
    docs = read_corpus(spark, str(tmp_path))
    assert sorted(map(tuple, docs.collect())) == sorted(AWKWARD)
    index = build_index(docs, new_stage_path(spark, "test"))
    paths, terms, postings = toy.plain_index(AWKWARD)
    assert [r.path for r in index.docs.orderBy("doc_id").collect()] == paths
    assert toy.pairs(index.postings()) == postings


def test_manifest_can_be_given(spark, tmp_path):
    _write(tmp_path, toy.MIXED)
    manifest = list_corpus(spark, str(tmp_path))
    assert manifest.count() == len(toy.MIXED)
    docs = read_corpus(spark, f"file://{tmp_path}", manifest)
    assert sorted(map(tuple, docs.collect())) == sorted(toy.MIXED)


def test_bad_bytes_fail(spark, tmp_path):
    _write(tmp_path, toy.MIXED)
    (tmp_path / "2" / "broken").write_bytes(b"ok \xff\xfe")
    with pytest.raises(Exception, match="not UTF-8"):
        read_corpus(spark, str(tmp_path)).collect()


def test_queries_expected_and_comparison(spark, tmp_path):
    _write(tmp_path / "corpus", toy.MIXED)
    asked, given = tmp_path / "queries", tmp_path / "expected"
    asked.mkdir()
    given.mkdir()
    for qid, query in {1: "alpha beta\n", 2: "gamma", 10: "nosuch", 11: "beta"}.items():
        (asked / f"query.{qid}").write_text(query)
    (asked / "notes.txt").write_text("ignored")
    (given / "1.out").write_text("0\\x\n./0!/B\n10//b.txt\n")
    (given / "2.out").write_text("0!/z \n0!/wrong\n10/b.txt\n")
    (given / "10.out").write_text("")
    (given / "11.out").write_text("0/x\n0!/B\n10/b.txt")
    index = build_index(read_corpus(spark, str(tmp_path / "corpus")), new_stage_path(spark, "t"))
    queries = read_queries(spark, str(asked))
    found = retrieve(open_index(spark, index.path), queries)
    ranked = rank_in_group(found, "qid", "doc_id", piece=4)
    expected = read_expected(spark, str(given))
    verdicts = compare.validate(queries, ranked, expected).collect()
    assert {r.qid: r.passed for r in verdicts} == {1: True, 2: False, 10: True, 11: False}
    first = {r.qid: tuple(r)[1:] for r in compare.first_mismatch(ranked, expected).collect()}
    assert first == {2: (1, "10/b.txt", "0!/wrong"), 11: (3, "2/c.txt", None)}
    sides = compare.set_difference(ranked, expected, ["qid", "path"]).collect()
    assert {(r.qid, r.path, r.side) for r in sides} == {
        (2, "0!/wrong", "right"),
        (11, "2/c.txt", "left"),
    }


def test_empty_lines_and_files_of_expected(spark, tmp_path):
    (tmp_path / "3.out").write_text("a/b\nc/d\n")
    (tmp_path / "4.out").write_text("e/f")
    rows = read_expected(spark, str(tmp_path)).orderBy("qid", "rank").collect()
    assert [tuple(r) for r in rows] == [(3, 0, "a/b"), (3, 1, "c/d"), (4, 0, "e/f")]


def test_result_files_keep_document_order(spark, tmp_path):
    rows = [(q, d, f"p{d}") for q in (1, 2) for d in range(500)]
    results = spark.createDataFrame(rows, "qid bigint, doc_id bigint, path string").repartition(6)
    write_results(results, str(tmp_path / "out"))
    for qid in (1, 2):
        folder = tmp_path / "out" / f"qid={qid}"
        files = sorted(f for f in os.listdir(folder) if f.endswith(".txt"))
        lines = [line for f in files for line in (folder / f).read_text().splitlines()]
        assert lines == [f"p{d}" for d in range(500)]


def _failing(spark, rows):
    """The rows, of which the last partition's fail while others are written."""
    name = F.when(F.col("name") == "bad", F.raise_error(F.lit("no name")).cast("string"))
    return spark.createDataFrame(rows, "block string, name string, text string").select(
        "block", F.coalesce(name, "name").alias("name"), "text"
    )


def test_a_failed_write_leaves_the_old_folder(spark, tmp_path):
    root = tmp_path / "corpus"
    write_corpus(toy.frame(spark, toy.MIXED), str(root))
    with pytest.raises(Exception, match="no name"):
        write_corpus(_failing(spark, [("2", "new", "x"), ("2", "bad", "y")]).repartition(2), str(root))
    docs = read_corpus(spark, str(root))
    assert sorted(map(tuple, docs.collect())) == sorted(toy.MIXED)
    assert os.listdir(tmp_path) == ["corpus"]  # nothing half written stays beside it


def test_a_write_replaces_the_folder(spark, tmp_path):
    for form in (str(tmp_path / "c"), f"file://{tmp_path}/c/"):
        write_corpus(toy.frame(spark, [("a", "old", "x")]), form)
        write_corpus(toy.frame(spark, AWKWARD), form)
        assert sorted(map(tuple, read_corpus(spark, form).collect())) == sorted(AWKWARD)
    write_corpus(toy.frame(spark, []), str(tmp_path / "none"))
    assert os.listdir(tmp_path / "none") == []
    with pytest.raises(Exception, match="written whole"):
        toy.frame(spark, AWKWARD).selectExpr("block as folder", "name", "text as content").write.format(
            "lexipost_folder"
        ).mode("append").option("path", str(tmp_path / "c")).save()


def test_expected_files_come_back(spark, tmp_path):
    rows = [(1, r, f"a/{r}") for r in range(300)] + [(3, 0, "b/x")]
    ranked = spark.createDataFrame(rows, "qid bigint, rank bigint, path string").repartition(5)
    queries = spark.createDataFrame([(1, "q"), (2, "none"), (3, "q")], "qid bigint, query string")
    write_expected(ranked, queries, str(tmp_path / "given"))
    assert (tmp_path / "given" / "2.out").read_text() == ""
    back = read_expected(spark, str(tmp_path / "given")).collect()
    assert sorted(map(tuple, back)) == rows


def test_each_file_is_read_once_and_not_by_the_driver(spark, tmp_path, monkeypatch):
    _write(tmp_path, AWKWARD)
    docs = read_corpus(spark, str(tmp_path))
    # What a build reads is the staged table: no listing, no join, no file of the corpus.
    plan = docs.select("block", "name")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Join" not in plan and "binaryFile" not in plan
    assert "ReadSchema: struct<block:string,name:string>" in plan
    empty = tmp_path / "nothing"
    empty.mkdir()
    assert read_corpus(spark, str(empty)).count() == 0
