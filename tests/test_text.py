import os
import random
import sys

from pyspark.sql import functions as F

from lexipost.functions.text import distinct_tokens, normal_path, tokens


def test_break_characters_are_those_of_python(spark):
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    import pandas as pd

    frame = spark.createDataFrame(pd.DataFrame({"c": points, "s": [f"a{chr(c)}b" for c in points]}))
    split = frame.filter(F.size(tokens("s")) == 2).select("c").collect()
    expected = [c for c in points if len(f"a{chr(c)}b".split()) == 2]
    assert sorted(row.c for row in split) == expected
    assert len(expected) == 29


def test_tokens_keep_case_and_punctuation(spark):
    texts = ["", " ", "a", " a b\n\nA, a.\ta ", "　x x\u001cy\u0085"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", tokens("t").alias("all"), distinct_tokens("t").alias("distinct")
    )
    for row in rows.collect():
        assert row["all"] == row.t.split()
        assert row["distinct"] == list(dict.fromkeys(row.t.split()))


def test_long_text_is_tokenised_whole(spark):
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(300_000)), lambda i: i % 70_000), " ")
    sizes = spark.range(1).select(F.size(tokens(text)), F.size(distinct_tokens(text))).first()
    assert tuple(sizes) == (300_001, 70_000)


def test_normal_path_is_normpath(spark):
    rng = random.Random(5)
    parts = ["a", "b.c", ".", "..", "", "0"]
    paths = {"", "/", "//", "///", "//a", "///a/..", "/..", "..", "a/..", "./0//f/", "../../a/../b"}
    paths |= {"/".join(rng.choice(parts) for _ in range(rng.randint(1, 7))) for _ in range(400)}
    rows = spark.createDataFrame([(p,) for p in sorted(paths)], "p string")
    for row in rows.select("p", normal_path("p").alias("n")).collect():
        assert row.n == os.path.normpath(row.p), row.p


def test_backslashes_are_separators(spark):
    row = spark.createDataFrame([("0\\page_1",)], "p string").select(normal_path("p").alias("n"))
    assert row.first().n == "0/page_1"
