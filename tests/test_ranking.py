import random

from pyspark.sql import functions as F

from lexipost.operators.ranking import dense_ids, exclusive_totals, rank_in_group
from lexipost.operators.skew import fetch_batch, heavy_key_bound, join_weighted


def test_dense_ids_are_ranks(spark):
    rng = random.Random(3)
    keys = sorted({(rng.choice("abc"), rng.randrange(5000)) for _ in range(3000)})
    shuffled = rng.sample(keys, len(keys))
    frame = spark.createDataFrame(shuffled, "a string, b bigint").repartition(7)
    got = sorted((r.a, r.b, r.id) for r in dense_ids(frame, ["a", "b"], "id", 10).collect())
    assert got == [(a, b, i + 10) for i, (a, b) in enumerate(keys)]


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.createDataFrame([], "a string"), ["a"], "id").count() == 0


def test_exclusive_totals(spark):
    frame = spark.range(100).select("id", (F.col("id") % 7 + 1).alias("v")).repartition(5)
    rows = exclusive_totals(frame, "id", {"v": "before"}, piece=8).orderBy("id").collect()
    total = 0
    for row in rows:
        assert row.before == total
        total += row.v


def test_rank_in_group(spark):
    rows = [(g, d) for g in range(3) for d in range(0, 200, g + 1)]
    frame = spark.createDataFrame(rows, "g bigint, d bigint").repartition(5)
    got = {(r.g, r.d): r.rank for r in rank_in_group(frame, "g", "d", piece=16).collect()}
    assert got == {(g, d): d // (g + 1) for g, d in rows}


def test_join_weighted_is_a_join(spark):
    rng = random.Random(1)
    words = [rng.choice(["the"] * 30 + [f"w{i}" for i in range(60)]) for _ in range(3000)]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "n bigint, w string")
    keyed = rows.groupBy("w").agg(F.count("*").alias("df"), F.min("n").alias("first"))
    assert heavy_key_bound(1) < 60  # both sides of the split are in use
    got = join_weighted(rows, keyed, "w", "df").select("n", "first").collect()
    firsts = {w: words.index(w) for w in set(words)}
    assert sorted(map(tuple, got)) == [(i, firsts[w]) for i, w in enumerate(words)]


def test_fetch_batch_counts_before_taking(spark):
    assert len(fetch_batch(spark.range(5), 5)) == 5
    assert fetch_batch(spark.range(6), 5) is None
