"""What tasks hold and move when tables grow and the session's shuffles do not."""

import pytest

from lexipost.operators import codecs, dictionary, gaps, inversion, retrieval, skew
from lexipost.plans import workload
from lexipost.plans.index import build_index, compact_index, extend_index
from lexipost.sinks import index as sinks
from lexipost.session import new_stage_path, stage
from lexipost.sources.tables import queries_from_rows
from toy import MIXED, frame

SMOKE = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def index(spark):
    return build_index(frame(spark, MIXED), new_stage_path(spark, "tasks"))


def test_a_join_takes_the_tasks_its_rows_ask_for(spark, monkeypatch):
    monkeypatch.setattr(skew, "_TASK_ROWS", 10)
    monkeypatch.setattr(skew, "_HEAVY_KEYS_MAX", 5)
    rows = spark.range(100).selectExpr("id % 20 as k", "id")
    keyed = spark.range(20).selectExpr("id as k", "5L as n")
    joined = skew.join_weighted(rows, keyed, "k", "n", whole=True)
    assert "REPARTITION_BY_NUM" in _plan(joined) and ", 10)" in _plan(joined)
    assert joined.count() == 100
    assert "REPARTITION_BY_NUM" not in _plan(skew.join_weighted(rows, keyed, "k", "n"))


def test_few_keys_leave_the_rows_where_they_are(spark):
    rows = spark.range(100).selectExpr("id % 20 as k", "id")
    keyed = spark.range(20).selectExpr("id as k", "5L as n")
    joined = skew.join_weighted(rows, keyed, "k", "n")
    assert "SortMergeJoin" not in _plan(joined) and joined.count() == 100


def test_windows_over_gaps_take_the_tasks_their_postings_ask_for(spark, index, monkeypatch):
    want = sorted(map(tuple, gaps.gaps(index.postings()).collect()))
    monkeypatch.setattr(skew, "_TASK_ROWS", 4)
    found = gaps.gaps(index.postings(), n_postings=28)
    assert "REPARTITION_BY_NUM" in _plan(found) and "hashpartitioning(term_id" in _plan(found)
    assert found.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, found.collect())) == want


def test_chunks_take_the_place_of_their_list_along(spark, index):
    rows = index.postings().selectExpr("*", "term_id * 10 as start")
    for codec in ("raw", "vb", "gamma"):
        for row in codecs.encode(rows, codec, ["start"]).collect():
            assert row.start == row.term_id * 10


def test_queries_of_the_forward_table_build_no_postings(spark, monkeypatch):
    def refuse(*args, **kwargs):
        raise AssertionError("no index is needed")

    monkeypatch.setattr(workload, "index_of", refuse)
    monkeypatch.setattr(workload, "_forward_tables", {})
    base = workload.lexicon(spark, SMOKE)
    assert workload.lexicon_extend(spark, SMOKE).count() == base.count()
    merged = workload.merge_segments(spark, SMOKE)
    assert merged.count() == workload.block_segments(spark, SMOKE).count()


def test_bitmaps_meet_queries_only_in_buckets_that_hold_all_terms(spark, monkeypatch):
    # "left" is in the first bucket of 32,768 documents, "right" in the second.
    texts = [(f"{i:06d}", "left" if i < 3 else "both left right" if i == 9 else "x") for i in range(32768)]
    texts += [("032768", "right"), ("032769", "both right left"), ("032770", "right")]
    docs = frame(spark, [("b", name, text) for name, text in texts])
    index = build_index(docs, new_stage_path(spark, "buckets"))
    batch = queries_from_rows(spark, [(1, "left right"), (2, "right x"), (3, "both")])
    found = retrieval.retrieve_by_bitmaps(index, batch, cap=0)
    assert "/buckets-" in _plan(found)
    got = sorted((r.qid, r.doc_id) for r in found.collect())
    assert got == [(1, 9), (1, 32769), (3, 9), (3, 32769)]


def test_a_scan_starts_from_the_rarest_term(spark):
    rows = [("b", f"{i}", "the of" if i % 2 else "the") for i in range(40)]
    docs = frame(spark, [*rows, ("b", "rare", "the of rare"), ("c", None, "rare the")])
    batch = queries_from_rows(spark, [(1, "the rare"), (2, "the of rare"), (3, "none the"), (4, "the")])
    found = retrieval.retrieve_by_scan(docs, batch, cap=0)
    got = sorted((r.qid, r.path) for r in found.collect())
    assert got == sorted((r.qid, r.path) for r in retrieval.retrieve_by_scan(docs, batch).collect())
    assert "/scan-candidates-" in _plan(found)


def test_large_batches_deal_out_the_rarest_lists_only(spark, index, monkeypatch):
    dealt = []
    meet = retrieval._meet
    monkeypatch.setattr(
        retrieval, "_meet", lambda lists, *more: dealt.append(lists.count()) or meet(lists, *more)
    )
    batch = queries_from_rows(spark, [(1, "alpha epsilon"), (2, "alpha zeta beta")])
    found = retrieval.retrieve(index, batch, cap=0)
    assert dealt == [2]
    want = retrieval.retrieve(index, batch).collect()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want))


def test_staged_tables_are_packed_by_zstd(spark):
    assert all(".zstd.parquet" in f for f in stage(spark.range(3), "packed").inputFiles())


def test_merged_segments_equal_the_postings(spark):
    forward = workload._forward(spark, SMOKE)
    rows = inversion.invert(forward, dictionary.build_lexicon(forward))
    assert workload.postings(spark, SMOKE).count() == rows.count()


def test_rows_of_one_name_count_together_in_a_scan(spark):
    rows = [("b", "half", "the"), ("b", "half", "the"), ("b", "whole", "the of"), ("b", "whole", "the of")]
    rows += [("b", "parts", "the"), ("b", "parts", "of"), ("b", "one", "of the"), (None, None, "the of")]
    docs = frame(spark, rows)
    batch = queries_from_rows(spark, [(1, "the of"), (2, "the none"), (3, "of"), (4, "the"), (5, "no")])
    got, want = (retrieval.retrieve_by_scan(docs, batch, **k).collect() for k in ({"cap": 0}, {}))
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and (1, "b/half") in map(tuple, got)


def test_tokens_move_as_one_string(spark):
    rows = [("b", "a", "two  words two"), ("b", "b", " \t"), ("b", "c", ""), ("b", "d", None), ("c", "a", "\x1fx\u2003é x")]
    documents = frame(spark, rows)
    docs = stage(dictionary.doc_dictionary(documents), "docs")
    forward = dictionary.doc_terms(documents, docs)
    got = [r.terms for r in forward.orderBy("doc_id").collect()]
    assert got == [["two", "words"], [], [], None, ["x", "é"]]
    assert "split(_told" in _plan(forward)


def test_the_heaviest_keys_do_not_move_where_every_row_has_a_key(spark, monkeypatch):
    monkeypatch.setattr(skew, "_HEAVY_KEYS_MAX", 4)
    weights = {k: 9 if k < 4 else 1 for k in range(24)}  # none weighs a fourth of the rows
    rows = spark.createDataFrame([(k, i) for k, n in weights.items() for i in range(n)], "k long, i long")
    keyed = spark.createDataFrame([(k, n, 10 * k) for k, n in weights.items()], "k long, n long, x long")
    for whole in (True, False):
        found = skew.join_weighted(rows, keyed, "k", "n", whole=whole)
        assert ("Union" in _plan(found)) == whole
        want = sorted((k, i, n, 10 * k) for k, n in weights.items() for i in range(n))
        assert sorted((r.k, r.i, r.n, r.x) for r in found.collect()) == want


def test_the_floor_of_heavy_keys_keeps_to_its_bounds():
    def classes(*of):
        return [{"_bits": b, "_keys": k, "_sum": s} for b, k, s in of]

    few = classes((10, 100, 60_000), (2, 90_000, 200_000), (1, 50_000, 50_000), (None, 5, None))
    assert skew._heavy_floor(few, 310_000, 4) == 2  # 50,000 keys more would be too many
    assert skew._heavy_floor(classes((1, 200_000, 200_000)), 200_000, 4) == 50_000
    rare = classes((8, 10, 2_000), (1, 200_000, 200_000))
    assert skew._heavy_floor(rare, 202_000, 4) == 50_500  # too few rows to read all twice


@pytest.mark.parametrize(("codec", "chunk_docs"), [("rows", 65_536), ("vb", 65_536), ("rows", 2), ("gamma", 2)])
def test_compaction_moves_rows_once(spark, monkeypatch, codec, chunk_docs):
    cut = chunk_docs == 2  # many lists are long then, and the join by term is needed
    texts = [("b", f"{i:02d}", f"the {'of' if i % 2 else 'to'} w{i} v{i % 5}") for i in range(20)]
    texts += [("c", f"{i:02d}", f"the w{i} x{i} v{i % 3}") for i in range(9)]
    path = new_stage_path(spark, "two")
    base = build_index(frame(spark, texts[:20]), path, codec, 2, chunk_docs)
    whole = build_index(frame(spark, texts), new_stage_path(spark, "one"), codec, 2, chunk_docs)
    two = extend_index(base, frame(spark, texts[20:]))
    plans = []
    write = sinks.write_postings
    monkeypatch.setattr(
        sinks, "write_postings", lambda rows, *more: plans.append(_plan(rows)) or write(rows, *more)
    )
    monkeypatch.setattr(skew, "_HEAVY_KEYS_MAX", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = compact_index(two, new_stage_path(spark, "compact"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("SortMergeJoin" in plans[0]) == cut
    for table in ("postings", "scan"):
        got, want = (sorted(map(tuple, getattr(x, table)().collect())) for x in (one, whole))
        assert got == want
    got, want = (sorted(map(tuple, x.lexicon.collect())) for x in (one, whole))
    assert got == want


def test_a_compacted_lexicon_moves_once(spark, index):
    parts = [index.lexicon, index.lexicon]
    found = dictionary.whole_lexicon(parts, by_range=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning(term" in plan
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, dictionary.whole_lexicon(parts).collect()))
