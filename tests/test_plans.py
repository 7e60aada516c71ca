"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import toy
from lexipost import build_index, retrieve
from lexipost.functions.codes import CODECS
from lexipost.functions.literals import one_of
from lexipost.operators import codecs, dictionary, retrieval, stats
from lexipost.operators.layout import Layout, list_places
from lexipost.session import new_stage_path, stage_dir
from lexipost.sources.tables import queries_from_rows, read_documents

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def index(spark):
    documents = read_documents(spark, DOCUMENTS, "source", "doc_id")
    return build_index(documents, new_stage_path(spark, "plans"), n_shards=8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_prunes_shards_and_pushes_term_ids(index):
    plan = _plan(index.postings_of([1, 9]))
    assert re.search(r"PartitionFilters: \[[^]]*shard#\d+L = 1", plan)
    assert "In(term_id, [1,9])" in plan
    files = index.postings_of([1, 9]).select(F.input_file_name().alias("f")).distinct().collect()
    assert all("/shard=1/" in row.f for row in files)


def test_small_results_skip_dictionary_directories(spark):
    documents = read_documents(spark, DOCUMENTS, "source", "doc_id")
    index = build_index(documents, new_stage_path(spark, "plans"), piece_docs=50)
    batch = queries_from_rows(spark, [(1, "the and of"), (2, "in the")])
    for ask in (retrieve, retrieval.retrieve_rarest_first):
        assert "dynamicpruning" in _plan(ask(index, batch))


def test_document_ids_never_read_the_text(spark):
    documents = read_documents(spark, DOCUMENTS, "source", "doc_id")
    plan = _plan(documents.select("block", "name"))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


def test_lexicon_literals_are_pushed(index):
    plan = _plan(index.lexicon.filter(F.col("term").isin("the", "of")))
    assert "PushedFilters: [In(term, [of,the])]" in plan


@pytest.mark.parametrize("codec", CODECS)
def test_codecs_run_in_the_jvm(index, codec):
    back = codecs.decode(codecs.encode(index.postings(), codec), codec)
    plan = _plan(back)
    assert "Python" not in plan and "Arrow" not in plan
    assert "SinglePartition" not in plan


def test_no_cross_join_anywhere(spark, index):
    batch = queries_from_rows(spark, [(1, "the and of"), (2, "in the")])
    documents = read_documents(spark, DOCUMENTS, "source", "doc_id")
    for df in (
        retrieve(index, batch),
        retrieve(index, batch, cap=0),
        retrieval.retrieve_rarest_first(index, batch),
        retrieval.retrieve_by_division(index, batch),
        retrieval.retrieve_by_division(index, batch, cap=0),
        retrieval.retrieve_by_scan(documents, batch),
        retrieval.retrieve_by_scan(documents, batch, cap=0),
    ):
        plan = _plan(df)
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_large_batches_broadcast_nothing(spark, index):
    batch = queries_from_rows(spark, [(1, "the and of"), (2, "in the")])
    automatic = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(retrieve(index, batch, cap=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic)


@pytest.mark.parametrize("codec", ["rows", "gamma"])
def test_large_batches_scan_the_postings_once(spark, codec):
    """The lists that are asked for are staged; no later step reads the index's own."""
    documents = read_documents(spark, DOCUMENTS, "source", "doc_id")
    index = build_index(documents, new_stage_path(spark, "plans"), codec, chunk_docs=16)
    batch = queries_from_rows(spark, [(1, "the and of"), (2, "in the"), (3, "The the")])
    for ask in (retrieve, retrieval.retrieve_by_division, retrieval.retrieve_by_bitmaps):
        plan = _plan(ask(index, batch, cap=0))
        assert "/postings" not in plan and "asked-lists" in plan
    plan = _plan(retrieve(index, batch, cap=0))
    assert "sequence(1," not in plan


def test_stop_words_are_shuffled_as_bitmaps(spark, index):
    batch = queries_from_rows(spark, [(1, "the and of"), (2, "in the")])
    plan = _plan(retrieval.retrieve_by_bitmaps(index, batch))
    at = plan.index("partial_bitmap_construct_agg")
    # Below the partial bitmaps, where single postings are, there is no shuffle.
    below = plan[at : plan.index("Scan parquet", at)]
    assert "Exchange hashpartitioning(term_id" not in below


@pytest.mark.parametrize("codec", ["rows", "vb"])
def test_postings_are_written_once_and_unsampled(spark, codec, monkeypatch):
    """Partitions come from running totals: neither a staged copy nor a range shuffle."""
    staged = []
    from lexipost.plans import index as plans

    real = plans.stage
    monkeypatch.setattr(plans, "stage", lambda df, label: staged.append(label) or real(df, label))
    documents = read_documents(spark, DOCUMENTS, "source", "doc_id")
    index = build_index(documents, new_stage_path(spark, "plans"), codec)
    assert staged == ["forward"]
    assert index.postings().count() == index.meta.n_postings


def test_partitions_follow_the_order_of_the_postings(spark, index):
    places = list_places(index.lexicon, index.meta.n_terms, 4)
    layout = Layout(4, index.meta.n_docs, index.meta.n_postings, 1 << 16, 100)
    rows = index.postings().join(places, "term_id").select(
        F.pmod("term_id", F.lit(4)).alias("shard"),
        "term_id",
        "doc_id",
        layout.part(F.col("df"), F.col("start"), F.col("doc_id")).alias("part"),
    )
    parts = [r.part for r in rows.orderBy("shard", "term_id", "doc_id").collect()]
    assert parts == sorted(parts) and max(parts) == layout.n_parts - 1
    sizes = [parts.count(p) for p in set(parts)]
    assert max(sizes) <= 3 * layout.rows  # a list of up to that many rows may start at the end


def test_only_piece_tables_meet_in_one_task(index):
    """A window without a key may only see one row per piece."""
    plan = _plan(stats.term_stats(index.postings()))
    for line in plan.splitlines():
        if "SinglePartition" in line:
            assert "_piece" in plan


def test_first_seen_is_a_hash_aggregation(spark):
    forward = spark.createDataFrame(
        [(0, "b", ["x", "y"])], "doc_id bigint, block string, terms array<string>"
    )
    plan = _plan(dictionary._first_seen(forward))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_stage_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert stage_dir(spark) == named.rstrip("/")


def test_staged_tables_are_files(spark):
    index = build_index(toy.frame(spark, toy.PARSED), new_stage_path(spark, "test"))
    assert "FileScan parquet" in _plan(index.lexicon)


@pytest.mark.parametrize("codec", CODECS)
def test_chunks_without_a_candidate_are_not_decoded(spark, codec):
    """A stop word's list is cut in 20; a rare word's documents touch few of its chunks."""
    rows = [("b", f"{i:04d}", f"stop w{i} " + ("rare" if i in (3, 205) else "x")) for i in range(400)]
    path = new_stage_path(spark, "plans")
    index = build_index(toy.frame(spark, rows), path, codec, chunk_docs=20)
    ids = {r.term: r.term_id for r in index.lexicon.collect()}
    checks = spark.createDataFrame(
        [(ids["stop"], 3), (ids["stop"], 205), (ids["x"], 3), (ids["w3"], 7)], "term_id bigint, doc_id bigint"
    )
    read = retrieval.chunks_holding(index, [ids["stop"], ids["x"], ids["w3"]], checks)
    met = {(r.term_id, r.chunk) for r in read.select("term_id", "chunk").distinct().collect()}
    # Document 3 lies inside the range of x's first chunk without being in it; w3 has one piece.
    assert met == {(ids["stop"], 1), (ids["stop"], 11), (ids["x"], 1)}
    plan = _plan(read)
    spans = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "payload" not in s]
    assert any("first_doc" in s and "last_doc" in s for s in spans)
    batch = queries_from_rows(spark, [(1, "rare stop"), (2, "stop x w3"), (3, "stop x w9")])
    found = retrieval.retrieve_rarest_first(index, batch).collect()
    assert sorted((r.qid, r.doc_id) for r in found) == [(1, 3), (1, 205), (3, 9)]


def test_lists_of_literals_reach_the_files(spark, index):
    """Longer lists than ten would be pushed down as a range; 256 go down value by value."""
    wanted = [f"w{i}" for i in range(25)] + ["the", "it's", "\\", "é"]
    plan = _plan(index.lexicon.filter(one_of("term", wanted)))
    pushed = plan[plan.index("PushedFilters") :]
    assert "Or(Or(In(term, [" in pushed and "GreaterThan" not in pushed
    found = {r.term for r in index.lexicon.filter(one_of("term", wanted)).collect()}
    assert found == {r.term for r in index.lexicon.collect()} & set(wanted)
    assert index.lexicon.filter(one_of("term", [str(i) for i in range(300)] + ["the"])).count() >= 1
    assert one_of("term_id", []) == "false"


def test_lexicon_files_have_bloom_filters(spark, index):
    files = index.lexicon.select(F.input_file_name().alias("f")).distinct().collect()
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for row in files:
        path = jvm.org.apache.hadoop.fs.Path(row.f)
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        blocks = reader.getFooter().getBlocks()
        columns = [c for i in range(blocks.size()) for c in blocks.get(i).getColumns()]
        names = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in columns}
        reader.close()
        assert names["term"] > 0 and names["df"] < 0


@pytest.mark.parametrize("codec", CODECS)
def test_chunks_follow_the_postings_and_not_the_documents(spark, codec):
    """Eight postings over 64 documents are two chunks of four, not one for each posting."""
    rows = [("b", f"{i:02d}", f"all w{i}" + (" some" if i % 8 == 5 else "")) for i in range(64)]
    index = build_index(toy.frame(spark, rows), new_stage_path(spark, "plans"), codec, chunk_docs=4)
    ids = {r.term: r.term_id for r in index.lexicon.collect()}
    found = index.postings().filter(F.col("term_id") == ids["some"]).collect()
    assert sorted((r.chunk, r.doc_id) for r in found) == [
        (i // 32 + 1, i) for i in range(64) if i % 8 == 5
    ]
    batch = queries_from_rows(spark, [(1, "some all"), (2, "w13 some"), (3, "w14 some")])
    want = [(1, i) for i in range(64) if i % 8 == 5] + [(2, 13)]
    for cap in (0, 1000):
        hits = retrieval.retrieve_rarest_first(index, batch, cap).collect()
        assert sorted((r.qid, r.doc_id) for r in hits) == want


@pytest.mark.parametrize("codec", ["vb", "gamma"])
def test_postings_are_encoded_in_one_pass(spark, codec):
    """Whole and cut lists come from one staged table, and no window sees single postings."""
    rows = spark.range(0, 400).selectExpr("id % 3 as term_id", "id % 3 * (id div 50 + 1) as chunk", "id as doc_id")
    plan = _plan(codecs.encode(rows, codec))
    assert "gap-chunks" in plan and "Range (" not in plan


def test_round_trip_sorts_no_single_postings(spark):
    rows = spark.range(0, 400).selectExpr("id % 3 as term_id", "id div 50 + 1 as chunk", "id as doc_id")
    plan = _plan(codecs.round_trip(rows))
    for line in plan.splitlines():
        if "Window [" in line:
            assert "lead(chunk" in line  # over the chunks of a list
    assert {tuple(r)[1:] for r in codecs.round_trip(rows).collect()} == {(400, 0)}


@pytest.mark.parametrize("codec", ["rows", "vb"])
def test_small_batches_with_many_candidates_narrow_them_first(spark, codec, monkeypatch):
    """Candidates meet the second shortest list before all the longer ones."""
    rows = [("b", f"{i:03d}", "a b c " + ("d e" if i % 3 else "d") + f" w{i}") for i in range(60)]
    index = build_index(toy.frame(spark, rows), new_stage_path(spark, "plans"), codec, chunk_docs=8)
    batch = queries_from_rows(spark, [(1, "a b e c"), (2, "w7 e a"), (3, "w9 e a"), (4, "w3"), (5, "e w8")])
    want = [(1, i) for i in range(60) if i % 3] + [(2, 7), (4, 3), (5, 8)]
    staged = []
    real = retrieval.stage
    monkeypatch.setattr(retrieval, "stage", lambda df, label: staged.append(label) or real(df, label))
    for bound in (30, 60, 10_000):
        monkeypatch.setattr(retrieval, "BROADCAST_ROWS", bound)
        staged.clear()
        hits = retrieval.retrieve_rarest_first(index, batch).collect()
        assert sorted((r.qid, r.doc_id) for r in hits) == want
        assert ("narrowed" in staged) == (bound < 10_000)
