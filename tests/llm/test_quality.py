import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexipost.llm import quality

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
        len(lines),
        len(set(words)),
    )


def shares(c):
    n_words, chars, symbols, same, repeated, lines, distinct = c
    return (symbols / chars, same / lines, repeated / n_words, 1 - distinct / n_words, chars / n_words)


def plain_tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def plain(docs, labels):
    """(doc_id, counts, base_failed, kept) by plain Python, for unique ids."""
    counted = [(r["doc_id"], r["lang"], plain_counts(r["text"])) for r in docs]
    base = {d: c[0] < 20 or 100 * c[4] > 30 * c[0] for d, _, c in counted}
    marks = {r["doc_id"]: r["quality"] for r in labels}
    cutoffs = list(zip(*[rule.cutoffs for rule in quality.RULES], strict=True))
    held = [(lang, marks[d], shares(c)) for d, lang, c in counted if d in marks and not base[d]]
    strata = {lang for lang, _, _ in held}
    step_of = {}
    for lang in strata:
        good = [s for at, q, s in held if at == lang and q == 1]
        bad = [s for at, q, s in held if at == lang and q == 0]
        best = 0.0
        for step, limits in enumerate(cutoffs):
            def over(s):
                return any(x > y for x, y in zip(s, limits, strict=True))

            false, true = sum(map(over, good)), sum(map(over, bad))
            if not good or plain_tail(false, len(good), quality.ALPHA) > quality.DELTA / len(strata):
                break
            gain = (true / len(bad) if bad else 0) - false / len(good)
            if gain > best:
                best, step_of[lang] = gain, step
    out = []
    for d, lang, c in counted:
        kept = not base[d]
        if kept and lang in step_of:
            kept = all(x <= y for x, y in zip(shares(c), cutoffs[step_of[lang]], strict=True))
        out.append((d, *c[:5], base[d], kept))
    return sorted(out), step_of


COLUMNS = ("doc_id", *quality.COUNTS[:5], "base_failed", "kept")


def test_documents_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = sorted(tuple(r) for r in quality.judge_quality(docs, labels).select(*COLUMNS).collect())
    expected, steps = plain(docs.collect(), labels.collect())
    assert found == expected
    assert steps  # the table is large enough to certify some cutoffs
    assert any(not row[-2] and not row[-1] for row in found)  # and the method rejects by them


def test_false_rejections_on_documents_that_certified_nothing(spark):
    """Cutoffs of one half of the labels, held against the other half."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("lang = 'en'")  # enough labels
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    judged = quality.judge_quality(docs, labels.filter(half)).filter("not base_failed")
    seen = judged.join(labels.filter(~half), "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int"))
    )
    kept = dict(seen.collect())
    assert kept[1] >= 1 - quality.ALPHA
    assert kept[0] <= 0.1


@pytest.mark.parametrize(("k", "n", "p"), [(0, 216, 0.02), (3, 500, 0.02), (40, 3000, 0.02), (1, 60, 0.3)])
def test_tail_is_the_exact_binomial_sum(k, n, p):
    assert quality.tail_chance(k, n, p) == pytest.approx(plain_tail(k, n, p), rel=1e-9)


def test_cutoffs_hold_in_repeated_draws():
    """A stratum whose rules falsely reject more than alpha is certified in few draws."""
    import numpy as np

    draws = np.random.default_rng(1).binomial(1000, quality.ALPHA * 1.01, 2000)
    level = quality.DELTA
    passed = [quality.chosen_step(1000, 10, [(int(k), 10)], quality.ALPHA, level) for k in draws]
    assert sum(p is not None for p in passed) / len(passed) <= quality.DELTA


def test_sequence_ends_at_the_first_failure():
    assert quality.chosen_step(1000, 10, [(0, 1), (500, 9), (0, 10)], 0.02, 0.1) == 0
    assert quality.chosen_step(1000, 10, [(0, 0), (0, 0)], 0.02, 0.1) is None
    assert quality.chosen_step(5, 10, [(0, 10)], 0.02, 0.1) is None
    assert quality.chosen_step(1000, 10, [(0, 5), (0, 5)], 0.02, 0.1) == 0


@pytest.mark.parametrize(
    "text",
    [
        None,
        "",
        " \n\t\x0b\x0c\r ",
        "a b c d e f g h",
        "a b c d e f g h a b c d e f g h",
        "x " * 9,
        "x " * 8,
        "a b c d e f g h i\na b c d e f g h j a b c d e f g h",
        "one\n\none\n one\none",
        "é è ### $%& 日本 <a|b>",
    ],
)
def test_counts_of_odd_texts(text):
    assert quality.text_counts(text) == plain_counts(text)


def test_nulls_repeats_clashes_and_empty_tables(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (None, 1), (5, None), (6, 1), (6, 1), (99, 0)], "doc_id bigint, quality int"
    )
    docs = edge_docs.withColumn("lang", F.when(F.col("doc_id") > 3, "en"))
    for name in (*quality.COUNTS, "step", "_stratum", "_rows"):
        docs = docs.withColumn(name, F.lit("?"))
    found = quality.judge_quality(docs, labels)
    assert sorted([tuple(r)[:6] for r in found.select(*COLUMNS).collect()], key=str) == sorted(
        [(r["doc_id"], *plain_counts(r["text"])[:5]) for r in docs.collect()], key=str
    )
    assert quality.judge_quality(docs, labels.filter("false")).count() == docs.count()
    assert quality.judge_quality(empty_docs.withColumn("lang", F.lit("")), labels).count() == 0
