import random

import pytest
from pyspark.sql import functions as F

from lexipost import schemas
from lexipost.functions import codes
from lexipost.operators.codecs import decode, encode, round_trip
from lexipost.operators.gaps import gaps, gaps_to_postings
from lexipost.operators.stats import list_sizes, size_report, term_stats

# list, variable-byte payload, gamma payload
VECTORS = [
    ([2, 3, 4, 5, 128], "020101017B", "A3F77F"),
    ([2, 3, 4, 235, 2335, 3546346], "0201018167903481D8A74B", "A7F67FFE069FFFFF584F2F"),
    ([0, 23, 333, 434, 42342, 223232], "001782366582C7348B851A", "79FFC6DFA5FFFE4769FFFF30A6BF"),
    ([0, 1, 2, 3], "00010101", "0F"),
    (
        [234, 262462, 2352333, 732979479],
        "816A908054FFC70F82DCB1F84A",
        "FED7FFFF80054FFFFF7F1C7FFFFFFFCB8C7C4A",
    ),
    ([2, 334, 5235, 23523, 234232], "02824CA625818E708CEE15", "BFE4CFFF192FFFE1DC3FFFE9B8AF"),
    ([1, 2, 300], "0101822A", None),
]
BIG = [0, 1, 127, 128, 16383, 16384, (1 << 56) - 1, 1 << 56, (1 << 62) + 5, (1 << 63) - 2]


def _postings(spark, lists, chunk_docs=None):
    rows = [
        (term, 0 if chunk_docs is None or len(ids) <= chunk_docs else doc // chunk_docs + 1, doc)
        for term, ids in lists.items()
        for doc in ids
    ]
    return spark.createDataFrame(rows, schemas.POSTINGS).repartition(3)


def _lists(df):
    found = {}
    for row in df.collect():
        found.setdefault(row.term_id, []).append(row.doc_id)
    return {term: sorted(ids) for term, ids in found.items()}


def _payloads(encoded):
    return {row.term_id: row.payload for row in encoded.collect()}


@pytest.mark.parametrize("codec, column", [("vb", 1), ("gamma", 2)])
def test_golden_payloads(spark, codec, column):
    lists = {i: vector[0] for i, vector in enumerate(VECTORS) if vector[column]}
    encoded = encode(_postings(spark, lists), codec)
    assert _payloads(encoded) == {i: VECTORS[i][column] for i in lists}
    assert _lists(decode(encoded, codec)) == lists


def test_raw_is_little_endian(spark):
    encoded = encode(_postings(spark, {0: [1, 2, 300]}), "raw")
    assert _payloads(encoded)[0] == "010000000000000002000000000000002C01000000000000"


def test_single_numbers(spark):
    numbers = spark.createDataFrame([(4,), (11280,), (0,), (3,), (135,)], "n bigint")
    vb = {r.n: r.c for r in numbers.select("n", codes.vb_code(F.col("n")).alias("c")).collect()}
    assert (vb[4], vb[11280], vb[0]) == ("04", "D810", "00")
    positive = numbers.filter("n > 0")
    gamma = {r.n: r.c for r in positive.select("n", codes.gamma_code(F.col("n")).alias("c")).collect()}
    assert (gamma[3], gamma[135]) == ("101", "1" * 7 + "0" + "0000111")


def test_gap_list(spark):
    gapped = gaps(_postings(spark, {0: [3, 6, 8, 999]}))
    assert [r.gap for r in gapped.orderBy("doc_id").collect()] == [3, 3, 2, 991]
    back = gaps_to_postings(gapped.withColumn("base", F.lit(0)), order="doc_id")
    assert _lists(back) == {0: [3, 6, 8, 999]}


def _random_lists(seed):
    rng = random.Random(seed)
    lists = {0: BIG, 1: [0], 2: list(range(40)), 3: [1 << 40]}
    for term in range(4, 40):
        top = rng.choice([10, 300, 1 << 20, 1 << 45])
        lists[term] = sorted({rng.randrange(top) for _ in range(rng.randint(1, 30))})
    return lists


@pytest.mark.parametrize("codec", codes.CODECS)
@pytest.mark.parametrize("chunk_docs", [None, 4])
def test_random_lists_round_trip(spark, codec, chunk_docs):
    lists = _random_lists(7)
    encoded = encode(_postings(spark, lists, chunk_docs), codec)
    assert _lists(decode(encoded, codec)) == lists


@pytest.mark.parametrize("codec", ["raw", "vb"])
def test_chunk_payloads_join_to_the_whole_list(spark, codec):
    lists = _random_lists(11)
    whole = _payloads(encode(_postings(spark, lists), codec))
    cut = {}
    for row in encode(_postings(spark, lists, 4), codec).orderBy("term_id", "chunk").collect():
        cut[row.term_id] = cut.get(row.term_id, "") + row.payload
    assert cut == whole


def test_sizes_are_those_of_the_payloads(spark):
    lists = _random_lists(13)
    whole = _postings(spark, lists)
    sizes = {r.term_id: r for r in list_sizes(whole).collect()}
    for codec in codes.CODECS:
        for term, payload in _payloads(encode(whole, codec)).items():
            assert sizes[term][codec] == len(payload) // 2
    cut = {r.term_id: r for r in list_sizes(_postings(spark, lists, 4)).collect()}
    assert cut == sizes


def test_term_stats_positions(spark):
    lists = {1: [2, 3, 4], 2: [3, 4, 5], 5: [9]}
    rows = term_stats(_postings(spark, lists), piece=2).filter("codec = 'raw'").orderBy("term_id")
    assert [(r.term_id, r.start_pos, r.n_postings, r.n_bytes) for r in rows.collect()] == [
        (1, 0, 3, 24),
        (2, 24, 3, 24),
        (5, 48, 1, 8),
    ]


def test_round_trip_audit_and_report(spark):
    postings = _postings(spark, _random_lists(17), 4)
    n = postings.count()
    assert {tuple(r) for r in round_trip(postings).collect()} == {
        (codec, n, 0) for codec in codes.CODECS
    }
    report = {r.codec: r for r in size_report(postings).collect()}
    assert report["raw"].n_bytes == 8 * n


@pytest.mark.parametrize("codec", codes.CODECS)
def test_no_postings(spark, codec):
    none = spark.createDataFrame([], schemas.POSTINGS)
    assert encode(none, codec).count() == 0
    assert decode(encode(none, codec), codec).count() == 0
    assert {r.n_bytes for r in size_report(none).collect()} == {0}


@pytest.mark.parametrize("codec", ["vb", "gamma"])
@pytest.mark.parametrize("ids", [[3, 3], [-1, 2]])
def test_lists_that_no_code_can_hold_fail(spark, codec, ids):
    with pytest.raises(Exception, match="distinct and not negative"):
        encode(_postings(spark, {0: ids}), codec).collect()


def test_unknown_codec(spark):
    with pytest.raises(ValueError):
        encode(_postings(spark, {0: [1]}), "zip")


def test_no_payload_passes_a_window(spark):
    rows = spark.range(0, 400).selectExpr("id % 3 as term_id", "id div 50 + 1 as chunk", "id as doc_id")
    plan = encode(rows, "gamma")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_head" in line]
    assert windows and all("payload" not in line for line in windows)
    below = plan[plan.index(windows[0]) :]
    assert "payload" not in below[: below.index("Relation")]
