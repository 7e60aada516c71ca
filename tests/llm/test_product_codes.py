import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexipost.llm import product_codes as pc

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """Every vector's code by plain Python on whole numbers."""
    kept = [
        r for r in rows
        if r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])
    ]
    kept.sort(key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["embedding"]))
    whole = [[math.floor(4096 * x) for x in r["embedding"]] for r in kept]
    width = len(whole[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(p, part):
        square = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return square.index(min(square)), min(square)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(nearest(p, v[p])[0], []).append(v[p])
            for e, members in groups.items():
                books[p][e] = tuple(sum(xs) // len(members) for xs in zip(*members))
    out, by_label = [], {}
    for r, v in zip(kept, cut):
        found = [nearest(p, v[p]) for p in range(parts)]
        error = sum(s for _, s in found)
        by_label[r["label"]] = by_label.get(r["label"], 0) + error
        out.append((r["vec_id"], "".join(f"{c:02x}" for c, _ in found), error, r["label"]))
    numbers = ",".join(str(x) for book in books for e in book for x in e)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return sorted([(i, c, e, by_label[at], digest) for i, c, e, at in out], key=str)


def ours(vectors):
    return sorted([tuple(r) for r in pc.compress_vectors(vectors).collect()], key=str)


def test_embeddings_equal_plain_python(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert ours(vectors) == plain(vectors.collect())


def test_nulls_ties_repeats_and_clashes(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 3, 16) / 4], i % 3) for i in range(40)]
    rows += rows[:7] + [(None, rows[3][1], None), (50, rows[4][1], None), (None, rows[3][1], None)]
    rows += [
        (51, None, 1), (52, [None] + [0.0] * 15, 1), (53, [math.nan] * 16, 2), (54, [-math.inf] * 16, 2),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA)
    for name in ("_key", "_label", "code", "error", "label_error", "keys", "data", "n"):
        vectors = vectors.withColumn(name, F.lit("?"))
    assert ours(vectors) == plain([r.asDict() for r in vectors.collect()])


def test_few_vectors_and_empty_tables(spark):
    few = spark.createDataFrame([(i, [i / 8] * 8, None) for i in range(3)], SCHEMA)
    assert ours(few) == plain(few.collect())
    assert ours(few.filter("false")) == []
    assert ours(spark.createDataFrame([(1, None, 1)], SCHEMA)) == []


def test_other_lengths_keep_their_rows(spark):
    rows = [(i, [i / 8] * 8, 1) for i in range(5)] + [(9, [0.5] * 16, 1), (10, [], 1), (11, [1.0], 2)]
    found = {r["vec_id"]: r for r in pc.compress_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == 8
    assert {i for i, r in found.items() if r["code"] is None} == {9, 10, 11}
    assert found[9]["label_error"] == found[1]["label_error"] is not None
    assert found[11]["label_error"] is None
    only = spark.createDataFrame([(1, [1.0], 1)], SCHEMA)
    assert [tuple(r)[:4] for r in pc.compress_vectors(only).collect()] == [(1, None, None, None)]


def test_large_components_fail(spark):
    with pytest.raises(Exception, match="below 4096"):
        ours(spark.createDataFrame([(1, [5000.0] * 8, 1)], SCHEMA))


@pytest.mark.parametrize("entries", [1, 2, 16, 64])
@pytest.mark.parametrize("spread", [2, 50, 4096])
def test_nearest_equals_all_distances(entries, spread):
    rng = np.random.default_rng(entries * spread)
    book = rng.integers(-spread, spread, (entries, 6))
    parts = rng.integers(-2 * spread, 2 * spread, (500, 6))
    index, square = pc.SlicedCodebook(book).nearest(parts)
    full = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (square == full.min(axis=1)).all()
    assert (index == full.argmin(axis=1)).all()


def test_masks_hold_the_entries_in_the_box():
    rng = np.random.default_rng(3)
    book = rng.integers(-9, 9, (64, 4))
    parts = rng.integers(-9, 9, (200, 4))
    radius = rng.integers(0, 9, 200)
    masks = pc.SlicedCodebook(book).candidates(parts, radius)
    inside = (np.abs(parts[:, None] - book[None]) <= radius[:, None, None]).all(axis=2)
    assert [[int(m) >> e & 1 for e in range(64)] for m in masks] == inside.astype(int).tolist()
