import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lexipost.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, fields=merkle.FIELDS):
    return h(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in fields])


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i : i + 3]) for i in range(0, len(low), 3)])
    return levels


def path(levels, at):
    steps = []
    for level in levels[:-1]:
        first = at // 3 * 3
        steps.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return steps


def plain(rows):
    """Every row's digests by plain Python."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        def order(r):
            key = r["doc_id"]
            return (key is not None, key or 0, leaf_of(r))

        groups[name].sort(key=order)
        trees[name] = tree([leaf_of(r) for r in groups[name]])
    top = tree([trees[n][-1][0] for n in names])
    out = []
    for i, name in enumerate(names):
        for at, r in enumerate(groups[name]):
            steps = path(trees[name], at) + path(top, i)
            changed = dict(r)
            key = r["doc_id"]
            if key is not None and zlib.crc32(str(key).encode()) % 2 == 0 and r["text"]:
                changed["text"] = r["text"].replace("\n", "")
            done = leaf_of(changed)
            for before, after in steps:
                done = h(*before, done, *after)
            root = top[-1][0]
            proof = h(*[x for before, after in steps for x in before + after])
            out.append((key, leaf_of(r), trees[name][-1][0], root, proof, done, done == root))
    return sorted(out, key=str)


def ours(docs):
    found = merkle.verify_rows(docs, {"text": merkle.without_line_ends()})
    return sorted([tuple(r) for r in found.collect()], key=str)


def table(spark, sizes, text="a\nb"):
    rows = [
        (i, f"{text}{i}", "en", source, i)
        for source, numbers in sizes.items()
        for i in numbers
    ]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )


def test_documents_equal_plain_python(small_docs):
    assert ours(small_docs) == plain([r.asDict() for r in small_docs.collect()])


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": range(1)},
        {"a": range(2)},
        {"a": range(3), None: range(3, 13)},
        {"b": range(4), "B": range(4, 31), "é": range(31, 32), "": range(32, 36)},
        {f"s{i}": [i] for i in range(10)},
    ],
)
def test_every_shape_equals_plain_python(spark, sizes):
    docs = table(spark, sizes)
    assert ours(docs) == plain([r.asDict() for r in docs.collect()])


def test_nulls_ties_repeats_and_clashes(edge_docs):
    docs = edge_docs.withColumn("lang", F.lit(None).cast("string")).withColumn("n_chars", F.lit(1))
    for name in ("tree", "pos", "lo", "hi", "digest", "kids", "steps", "leaf", "root", "subroot"):
        docs = docs.withColumn(name, F.lit("?"))
    found = ours(docs)
    assert found == plain([r.asDict() for r in docs.collect()])
    assert len(found) == docs.count()


def test_empty_table(empty_docs):
    docs = empty_docs.withColumn("lang", F.lit("")).withColumn("n_chars", F.lit(1))
    assert ours(docs) == []


def test_only_changed_rows_fail(spark):
    docs = table(spark, {"a": range(40), "b": range(40, 47)})
    claimed = {"text": F.when(F.col("doc_id") == 17, F.lit("other")).otherwise(F.col("text"))}
    found = merkle.verify_rows(docs, claimed)
    assert [r["doc_id"] for r in found.filter(~F.col("verified")).collect()] == [17]


def test_labels_are_nested_and_cover_their_level(spark):
    manifest = merkle.build_manifest(table(spark, {"a": range(40), "b": range(40, 47)}))
    nodes = [r.asDict() for r in manifest.nodes.collect()]
    for tree_id, leaves in ((0, (0, 40)), (1, (40, 47)), (-1, (0, 47))):
        own = [n for n in nodes if n["tree"] == tree_id]
        for level in {n["level"] for n in own}:
            spans = sorted((n["lo"], n["hi"]) for n in own if n["level"] == level)
            assert (spans[0][0], spans[-1][1]) == leaves
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
            for lo, hi in spans:
                above = [n for n in own if n["level"] == level + 1 and n["lo"] <= lo and hi <= n["hi"]]
                assert len(above) == (len(spans) > 1)
