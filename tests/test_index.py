from pathlib import Path

import pytest

import toy
from lexipost import (
    build_index,
    compact_index,
    extend_index,
    merge_indexes,
    open_index,
    retrieve,
    retrieve_by_scan,
    retrieve_rarest_first,
)
from lexipost.operators import dictionary, inversion, retrieval
from lexipost.session import new_stage_path
from lexipost.sources.tables import queries_from_rows

QUERIES = [
    (1, "alpha"),
    (2, "alpha beta"),
    (3, "beta alpha alpha"),
    (4, "nosuch alpha"),
    (5, ""),
    (6, " 　\n"),
    (7, "Alpha"),
    (8, "delta\u001cepsilon"),
    (9, "gamma beta alpha"),
]


def _build(spark, rows, **options):
    return build_index(toy.frame(spark, rows), new_stage_path(spark, "test"), **options)


def _expected(rows, queries):
    paths, terms, postings = toy.plain_index(rows)
    lists = {}
    for term_id, doc_id in postings:
        lists.setdefault(term_id, set()).add(doc_id)
    found = []
    for qid, query in queries:
        words = set(query.split())
        if words and words <= terms.keys():
            docs = set.intersection(*[lists[terms[word]] for word in words])
            found += [(qid, doc, paths[doc]) for doc in sorted(docs)]
    return found


def _assert_equals_plain(index, rows):
    paths, terms, postings = toy.plain_index(rows)
    assert [r.path for r in index.docs.orderBy("doc_id").collect()] == paths
    assert {r.term: r.term_id for r in index.lexicon.collect()} == terms
    assert toy.pairs(index.postings()) == postings
    df = {r.term_id: r.df for r in index.lexicon.collect()}
    assert df == {t: sum(1 for p in postings if p[0] == t) for t in terms.values()}
    assert (index.meta.n_docs, index.meta.n_terms, index.meta.n_postings) == (
        len(paths),
        len(terms),
        len(postings),
    )


def test_parsed_texts(spark):
    index = _build(spark, toy.PARSED)
    _assert_equals_plain(index, toy.PARSED)
    assert index.meta.n_terms == 12 and index.meta.n_postings == 20
    batch = queries_from_rows(spark, [(1, "hello B"), (2, "hello nosuch"), (3, "")])
    assert [(r.qid, r.path) for r in retrieve(index, batch).collect()] == [(1, "0/test_parse2")]


@pytest.mark.parametrize(
    "codec, chunk_docs", [("rows", 1 << 16), ("rows", 2), ("raw", 2), ("vb", 2), ("gamma", 1 << 16)]
)
def test_every_way_to_retrieve(spark, codec, chunk_docs):
    index = _build(
        spark, toy.MIXED, codec=codec, chunk_docs=chunk_docs, n_shards=3, piece_docs=2
    )
    _assert_equals_plain(index, toy.MIXED)
    expected = _expected(toy.MIXED, QUERIES)
    assert expected
    batch = queries_from_rows(spark, QUERIES)
    for ask in (retrieve, retrieve_rarest_first, retrieval.retrieve_by_division):
        for cap in (0, 1000):
            rows = ask(index, batch, cap).orderBy("qid", "doc_id").collect()
            assert [tuple(r) for r in rows] == expected


def test_the_choice_of_plan_does_not_change_results(spark, monkeypatch):
    index = _build(spark, toy.MIXED)
    batch = queries_from_rows(spark, QUERIES)
    monkeypatch.setattr(retrieval, "BROADCAST_ROWS", 0)
    rows = retrieve(index, batch).orderBy("qid", "doc_id").collect()
    assert [tuple(r) for r in rows] == _expected(toy.MIXED, QUERIES)


@pytest.mark.parametrize("cap", [0, 1000])
def test_retrieve_by_scan(spark, cap):
    rows = retrieve_by_scan(toy.frame(spark, toy.MIXED), queries_from_rows(spark, QUERIES), cap)
    expected = sorted((qid, path) for qid, _, path in _expected(toy.MIXED, QUERIES))
    assert sorted(map(tuple, rows.collect())) == expected


def test_queries_leave_the_lexicon_alone(spark):
    index = _build(spark, toy.MIXED)
    retrieve(index, queries_from_rows(spark, [(1, "nosuch")])).collect()
    _assert_equals_plain(open_index(spark, index.path), toy.MIXED)


def test_rebuilding_in_place_changes_nothing(spark):
    index = _build(spark, toy.MIXED)
    build_index(toy.frame(spark, toy.MIXED), index.path)
    _assert_equals_plain(open_index(spark, index.path), toy.MIXED)


@pytest.mark.parametrize("codec", ["rows", "gamma"])
def test_extending_equals_a_full_build(spark, codec):
    first = [row for row in toy.MIXED if row[0] <= "0!"]
    index = _build(spark, first, codec=codec, chunk_docs=4, n_shards=2)
    # The whole table again: what is indexed already must be skipped.
    longer = extend_index(index, toy.frame(spark, toy.MIXED), new_stage_path(spark, "test"))
    _assert_equals_plain(longer, toy.MIXED)
    full = _build(spark, toy.MIXED, codec=codec, chunk_docs=4, n_shards=2)
    columns = ["term_id", "chunk", "doc_id"]
    assert sorted(map(tuple, longer.postings().select(columns).collect())) == sorted(
        map(tuple, full.postings().select(columns).collect())
    )
    compact = compact_index(longer, new_stage_path(spark, "test"))
    _assert_equals_plain(compact, toy.MIXED)
    assert sorted(map(tuple, compact.postings().select(columns).collect())) == sorted(
        map(tuple, full.postings().select(columns).collect())
    )


def _files(index):
    root = Path(index.path.removeprefix("file://"))
    return {str(f): f.stat().st_mtime_ns for f in root.rglob("*.parquet")}


def test_appending_rewrites_no_file(spark):
    codec, blocks = "vb", sorted({row[0] for row in toy.MIXED})
    index = _build(spark, [r for r in toy.MIXED if r[0] == blocks[0]], codec=codec, chunk_docs=2)
    before = _files(index)
    for part in (blocks[1:2], blocks[2:]):
        batch = toy.frame(spark, [r for r in toy.MIXED if r[0] in part])
        index = extend_index(index, batch)
    after = _files(index)
    assert before.items() <= after.items() and len(after) > len(before)
    assert len(index.meta.segments) == 3
    reopened = open_index(spark, index.path)
    _assert_equals_plain(reopened, toy.MIXED)
    full = _build(spark, toy.MIXED, codec=codec, chunk_docs=2)
    assert sorted(map(tuple, reopened.postings().collect())) == sorted(
        map(tuple, full.postings().collect())
    )
    asked = queries_from_rows(spark, [(1, "alpha"), (2, "alpha beta"), (3, "nosuch alpha")])
    for cap in (10_000, 0):
        found = [sorted(map(tuple, retrieve(i, asked, cap).collect())) for i in (reopened, full)]
        assert found[0] == found[1]
    compact_index(index)
    assert len(open_index(spark, index.path).meta.segments) == 1
    _assert_equals_plain(open_index(spark, index.path), toy.MIXED)


@pytest.mark.parametrize(("codec", "chosen"), [("rows", [0, 1, 2]), ("gamma", [2, 0])])
def test_merging_equals_a_full_build(spark, codec, chosen):
    """Inputs share documents and have dictionaries of their own."""
    rows = toy.MIXED
    parts = [rows[::2], rows[1::3], rows]
    indexes = [_build(spark, parts[i], codec=codec, chunk_docs=3) for i in chosen]
    merged = merge_indexes(indexes, new_stage_path(spark, "test"))
    _assert_equals_plain(merged, rows)
    full = _build(spark, rows, codec=codec, chunk_docs=3)
    for table in ("docs", "lexicon", "postings"):
        ours, theirs = getattr(open_index(spark, merged.path), table), getattr(full, table)
        if table == "postings":
            ours, theirs = ours(), theirs()
        assert sorted(map(tuple, ours.select(theirs.columns).collect())) == sorted(
            map(tuple, theirs.collect())
        )


def test_merging_extended_and_empty_indexes(spark):
    blocks = sorted({row[0] for row in toy.MIXED})
    base = _build(spark, [r for r in toy.MIXED if r[0] <= blocks[1]])
    longer = extend_index(base, toy.frame(spark, toy.MIXED))
    merged = merge_indexes([_build(spark, []), longer], new_stage_path(spark, "test"))
    _assert_equals_plain(merged, toy.MIXED)
    nothing = merge_indexes([_build(spark, [])] * 2, new_stage_path(spark, "test"))
    assert (nothing.meta.n_docs, nothing.meta.n_terms, nothing.postings().count()) == (0, 0, 0)
    with pytest.raises(ValueError, match="no index"):
        merge_indexes([], new_stage_path(spark, "test"))


def test_a_shared_document_is_taken_from_the_first_index(spark):
    one = _build(spark, [("a", "x", "red green")])
    two = _build(spark, [("a", "x", "blue"), ("a", "y", "blue green")])
    merged = merge_indexes([one, two], new_stage_path(spark, "test"))
    terms = {r.term: (r.term_id, r.df) for r in merged.lexicon.collect()}
    assert terms == {"red": (0, 1), "green": (1, 2), "blue": (2, 1)}


def test_extending_by_nothing(spark):
    index = _build(spark, toy.MIXED)
    same = extend_index(index, toy.frame(spark, toy.MIXED), new_stage_path(spark, "test"))
    _assert_equals_plain(same, toy.MIXED)


def test_no_documents(spark):
    index = _build(spark, [])
    assert index.postings().count() == 0
    assert retrieve(index, queries_from_rows(spark, [(1, "alpha")])).count() == 0


def test_merge_keeps_a_shared_document_once(spark):
    schema = "term_id bigint, doc_id bigint"
    left = spark.createDataFrame([(1, 2), (4, 2), (2, 3), (1, 3), (1, 4)], schema)
    right = spark.createDataFrame([(1, 4), (4, 5), (2, 5), (2, 10)], schema)
    merged = inversion.merge_segments([left, right])
    assert toy.pairs(merged) == [
        (1, 2), (1, 3), (1, 4), (2, 3), (2, 5), (2, 10), (4, 2), (4, 5),
    ]
    frequency = inversion.document_frequency(merged)
    chunked = inversion.add_chunks(merged, frequency, chunk_docs=2)
    assert {(r.term_id, r.chunk) for r in chunked.collect()} == {
        (1, 2), (1, 3), (2, 2), (2, 3), (2, 6), (4, 0),
    }
    lists = inversion.posting_lists(inversion.add_chunks(merged, frequency))
    assert {r.term_id: r.doc_ids for r in lists.collect()} == {
        1: [2, 3, 4], 2: [3, 5, 10], 4: [2, 5],
    }


def test_dictionary_lookups(spark):
    docs = toy.frame(spark, [("0", "f", "a bcd a")])
    index = build_index(docs, new_stage_path(spark, "test"))
    terms = spark.createDataFrame([("a",), ("bcd",), ("a",), ("x",)], "term string")
    assert sorted(map(tuple, dictionary.term_to_id(index.lexicon, terms).collect())) == [
        ("a", 0), ("bcd", 1),
    ]
    ids = spark.createDataFrame([(1,), (2,), (-1,)], "term_id bigint")
    assert [tuple(r) for r in dictionary.id_to_term(index.lexicon, ids).collect()] == [(1, "bcd")]
    sizes = dictionary.dictionary_sizes(index.lexicon, index.docs).collect()
    assert {tuple(r) for r in sizes} == {("docs", 1), ("terms", 2)}


@pytest.mark.parametrize("cap", [0, 1000])
def test_lookup_and_intersection(spark, cap):
    index = _build(spark, toy.MIXED, n_shards=3)
    _, terms, postings = toy.plain_index(toy.MIXED)
    asked = spark.createDataFrame([("alpha",), ("beta",), ("nosuch",)], "term string")
    found = retrieval.postings_lookup(index, asked, cap).collect()
    assert sorted(map(tuple, found)) == sorted(
        (word, doc) for word in ("alpha", "beta") for term, doc in postings if term == terms[word]
    )
    alpha, beta = ({d for t, d in postings if t == terms[w]} for w in ("alpha", "beta"))
    both = retrieval.postings_intersect(index, terms["alpha"], terms["beta"]).collect()
    assert sorted(r.doc_id for r in both) == sorted(alpha & beta)
