"""Near-duplicates against all pairs, and the parts they are made of."""

import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexipost.llm import near_dedup
from lexipost.llm.components import connected_components
from lexipost.llm.near_dedup import _tiles, near_duplicates
from lexipost.llm.superminhash import WordHashes, shingle_set, signatures


def shingles(text, words):
    at = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        at = at.replace(space, " ")
    at = [w for w in at.split(" ") if w]
    if not at:
        return frozenset()
    size = min(words, len(at))
    return frozenset(tuple(at[i : i + size]) for i in range(len(at) - size + 1))


def brute(rows, words):
    """{row number: (n, component)} by all pairs of different sets."""
    sets = [shingles(r.text, words) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            root[find(b)] = find(a)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r.doc_id)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(r.doc_id, len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets))]


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def test_whole_table_equals_all_pairs(spark, small_docs):
    want = brute(small_docs.select("doc_id", "text").collect(), 2)
    assert found(near_duplicates(small_docs, words=2)) == sorted(want, key=str)


def test_edges(edge_docs, empty_docs):
    want = brute(edge_docs.select("doc_id", "text").collect(), 5)
    assert found(near_duplicates(edge_docs)) == sorted(want, key=str)
    assert near_duplicates(empty_docs).count() == 0


@pytest.mark.parametrize("tile", [near_dedup.TILE, 16])
def test_family_of_copies_around_the_threshold(spark, monkeypatch, tile):
    """Edited copies, some of which are linked only by way of others."""
    monkeypatch.setattr(near_dedup, "TILE", tile)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(250):
        words = list(base)
        for at in rng.integers(0, 60, rng.integers(0, 6)):
            words[at] = f"x{rng.integers(0, 50)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(docs.collect(), 2)
    assert len({c for _, _, c in want}) > 3  # not all are one group
    assert found(near_duplicates(docs, words=2)) == sorted(want, key=str)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 1 << 63, 1_000, dtype=np.uint64))
    for shared in (900, 500):
        b = np.concatenate((a[:shared], rng.integers(0, 1 << 63, len(a) - shared, dtype=np.uint64)))
        sig = signatures(np.concatenate((a, b)), np.array([len(a), len(b)]), 128)
        true = shared / (2 * len(a) - shared)
        assert abs((sig[0] == sig[1]).mean() - true) < 0.13


def test_signature_does_not_depend_on_the_batch():
    hashes = WordHashes()
    sets = [shingle_set(t, 2, hashes) for t in ("a", "a b c", " ".join(map(str, range(3_000))))]
    together = signatures(np.concatenate(sets), np.array([len(s) for s in sets]), 64)
    for row, one in zip(together, sets):
        assert np.array_equal(row, signatures(one, np.array([len(one)]), 64)[0])


def test_slot_ranks_are_permutations():
    """One element fills all slots, once per rank."""
    sig = signatures(np.array([7, 9], np.uint64), np.array([1, 1]), 64)
    assert [sorted(np.floor(r).astype(int)) for r in sig] == [list(range(64))] * 2


def test_tiles_bring_all_pairs_of_different_labels_together(spark, monkeypatch):
    """Also of labels that have chunks of their own, which do not meet themselves."""
    monkeypatch.setattr(near_dedup, "TILE", 5)
    rows = [(7, i, 1000 if i < 23 else i % 4) for i in range(60)] + [(8, 90, 5), (8, 91, 5)]
    tiled = _tiles(spark.createDataFrame(rows, "part bigint, node bigint, label bigint"), [])
    tiles = {}
    for r in tiled.collect():
        tiles.setdefault(r.tile, []).append(r)
    met = Counter()
    for members in tiles.values():
        chunks = {r.chunk for r in members}
        assert len(chunks) <= 2
        for a, b in itertools.combinations(members, 2):
            if a.label != b.label and (a.chunk != b.chunk or len(chunks) == 1):
                met[frozenset((a.node, b.node))] += 1
    want = [{a[1], b[1]} for a, b in itertools.combinations(rows[:60], 2) if a[2] != b[2]]
    assert len(met) == len(want) and set(met.values()) == {1}
    big = [m for m in tiles.values() if {r.label for r in m} == {1000}]
    assert not big and 90 not in {r.node for m in tiles.values() for r in m}


def test_tasks_follow_comparisons(spark, monkeypatch):
    """Many small parts need no more tasks, a large one does, and a group of its own does not."""
    monkeypatch.setattr(near_dedup, "TILE", 4)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "part bigint, node bigint, label bigint"

    def tasks(rows):
        return _tiles(spark.createDataFrame(rows, schema), []).rdd.getNumPartitions()

    assert tasks([(i // 2, i, i) for i in range(200)]) == least
    assert tasks([(1, i, i) for i in range(200)]) == 200 * 200 // 2 // 16 // near_dedup.TILES_OF_TASK
    assert tasks([(1, i, 7) for i in range(200)] + [(1, 900, 900)]) == least


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    edges += [(200, 200), (5, 4), (None, 3), (301, 300), (300, 301)]
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    roots = {r.node: r.component for r in got.collect()}
    assert {roots[i] for i in range(41)} == {0}
    assert {roots[i] for i in range(100, 160)} == {100}
    assert roots[200] == 200 and roots[301] == 300
    assert got.count() == got.select(F.countDistinct("node")).first()[0]
