"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects documents above a cutoff of one share, such as symbols per character. All
rules move together over a fixed grid of steps, from mild cutoffs to strict ones. For
every stratum (a language) the steps are tried in that order: a step is certified if the
good labelled documents that its rules reject together are so few that a false rejection
rate above ``alpha`` is refuted, that is, if the exact binomial chance of so few does not
exceed ``delta / strata``. The first step that fails ends the sequence, so only the number
of strata needs a correction. With probability 1 - delta, then, every stratum at once has
at most ``alpha`` of its good documents rejected, whichever certified step is used. It is
the one that best separates bad from good labelled documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexipost.llm.arrow import map_batches
from lexipost.operators.skew import join_weighted
from lexipost.session import stage

WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: The share of good documents that may be rejected in a stratum, and the chance that any
#: stratum exceeds it.
ALPHA, DELTA = 0.02, 0.1


@dataclass(frozen=True)
class QualityRule:
    """``share`` is SQL over the counts; above a cutoff it rejects. Mildest cutoff first."""

    name: str
    share: str
    cutoffs: tuple[float, ...]


RULES = (
    QualityRule("symbols", "try_divide(n_symbols, word_chars)", (0.3, 0.2, 0.1, 0.05, 0.03, 0.02)),
    QualityRule("same_lines", "try_divide(n_dup_lines, n_lines)", (0.9, 0.7, 0.5, 0.4, 0.3, 0.2)),
    QualityRule(
        "repeats", "try_divide(n_repeat_words, n_words)", (0.29, 0.28, 0.26, 0.24, 0.22, 0.2)
    ),
    QualityRule(
        "variety", "1 - try_divide(n_distinct, n_words)", (0.98, 0.96, 0.94, 0.92, 0.9, 0.85)
    ),
    QualityRule(
        "long_words", "try_divide(word_chars, n_words)", (30.0, 20.0, 15.0, 12.0, 10.0, 9.0)
    ),
)
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct"
)


def repeated_words(words: Sequence[bytes]) -> tuple[int, int]:
    """(different words, words in windows that occur twice or more).

    Runs of 1, 2, 4 and 8 words are numbered by equality, each from two runs half as long,
    so equal numbers are equal words: nothing is hashed. Stops where no run is repeated.
    """
    numbers: dict[bytes, int] = {}
    runs = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    half = 1
    while half < WINDOW_WORDS:
        if len(runs) <= half:
            return len(numbers), 0
        pairs = runs[:-half] * (runs.max() + 1) + runs[half:]
        kinds, runs = np.unique(pairs, return_inverse=True)
        if len(kinds) == len(pairs):
            return len(numbers), 0
        half *= 2
    starts = np.flatnonzero(np.bincount(runs)[runs] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW_WORDS, -1)
    return len(numbers), int(np.count_nonzero(np.cumsum(edges)))


def text_counts(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` of a whole text; all 0 for null.

    Words are runs of anything but the six ASCII white spaces, which is how bytes split.
    """
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    blank = sum(text.count(c) for c in _SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    distinct, repeated = repeated_words(words) if words else (0, 0)
    return (
        len(words), len(text) - blank, symbols, len(lines) - len(set(lines)), repeated,
        len(lines), distinct,
    )


def measured(
    docs: DataFrame, key: str = "doc_id", stratum: str = "lang", text: str = "text"
) -> DataFrame:
    """(_key, _stratum, counts) of every row, from its whole text."""
    rows = docs.select(
        F.col(key).alias("_key"),
        # Null is a stratum of its own; the mark keeps it apart from every name.
        F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("-")).alias("_stratum"),
        F.col(text).cast("string").alias("_text"),
    )
    kind = dict(rows.dtypes)["_key"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_counts(t.as_py()) for t in batch.column("_text")]
            table = np.array(found, np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("_stratum"), *map(pa.array, table.T.copy())],
                ["_key", "_stratum", *COUNTS],
            )

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return map_batches(rows, work, f"_key {kind}, _stratum string, {counts}")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def tail_chance(rejected: int, of: int, rate: float) -> float:
    """The chance of ``rejected`` or fewer in ``of`` trials at ``rate``, summed exactly.

    Terms fall from the last one down while it lies below the mean. At the mean or above
    it no cutoff is ever certified, so 1 stands for any such chance.
    """
    if of == 0 or rejected >= of * rate:
        return 1.0
    log = (
        math.lgamma(of + 1) - math.lgamma(rejected + 1) - math.lgamma(of - rejected + 1)
        + rejected * math.log(rate) + (of - rejected) * math.log1p(-rate)
    )
    total, term, k = 1.0, 1.0, rejected
    while k > 0 and term > 1e-18 * total:
        term *= k * (1 - rate) / ((of - k + 1) * rate)
        total += term
        k -= 1
    return min(1.0, math.exp(log) * total)


def chosen_step(
    good: int, bad: int, rejected: Sequence[tuple[int, int]], alpha: float, level: float
) -> int | None:
    """Which step to use: (good, bad) documents rejected by each, mildest first.

    None if none is certified or none rejects a larger share of bad than of good.
    """
    best, at = 0.0, None
    for step, (false, true) in enumerate(rejected):
        if tail_chance(false, good, alpha) > level:
            break
        gain = (true / bad if bad else 0.0) - false / good
        if gain > best:
            best, at = gain, step
    return at


def _over(rule: QualityRule, step: int) -> Column:
    return F.coalesce(F.expr(f"{rule.share} > {rule.cutoffs[step]}D"), F.lit(False))


def certified_steps(
    counts: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    quality: str = "quality",
    rules: Sequence[QualityRule] = RULES,
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """(_stratum, step) of strata with labelled documents; a null step rejects nothing.

    ``counts`` is as from ``measured``. All labelled documents that pass the base rules
    are used, each id once: of equal ids, the row with the least counts. A quality above 0
    is good. Ids without a quality or with two are left out.
    """
    steps = {len(rule.cutoffs) for rule in rules}
    if len(steps) != 1:
        raise ValueError("every rule needs as many cutoffs as the others")
    numbers = range(*steps)
    marks = (
        labels.filter(F.col(key).isNotNull() & F.col(quality).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(quality).alias("_low"), F.max(quality).alias("_high"))
        .filter("_low = _high")
        .select("_key", (F.col("_low") > 0).alias("_good"))
    )
    # One row per id before the join: rows of a hot id are merged where they are read.
    single = (
        counts.filter(F.col("_key").isNotNull() & ~base_failed())
        .groupBy("_key")
        .agg(F.min(F.struct("_stratum", *COUNTS)).alias("_row"))
        .select("_key", "_row.*")
    )
    good = F.col("_good")
    tallies = [F.count_if(good).alias("good"), F.count_if(~good).alias("bad")]
    for step in numbers:
        over = reduce(Column.__or__, [_over(rule, step) for rule in rules])
        tallies.append(F.count_if(good & over).alias(f"good_{step}"))
        tallies.append(F.count_if(~good & over).alias(f"bad_{step}"))
    per_stratum = stage(
        single.join(marks, "_key").groupBy("_stratum").agg(*tallies), "quality-tallies"
    )
    level = delta / max(1, per_stratum.count())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [
                chosen_step(
                    row["good"],
                    row["bad"],
                    [(row[f"good_{step}"], row[f"bad_{step}"]) for step in numbers],
                    alpha,
                    level,
                )
                for row in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_stratum"), pa.array(chosen, pa.int32())], ["_stratum", "step"]
            )

    return map_batches(per_stratum, work, "_stratum string, step int")


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    stratum: str = "lang",
    text: str = "text",
    quality: str = "quality",
    rules: Sequence[QualityRule] = RULES,
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """(key, counts, base_failed, failed_rules, kept), one row per row of ``docs``.

    ``failed_rules`` names the rules that a document exceeds at its stratum's certified
    step, joined by commas; it is kept if there are none and the base rules hold. A
    stratum without enough labelled documents has no certified step and rejects nothing
    beyond the base rules. A null or blank text has no words and fails the base. Null keys
    are judged and never labelled; repeated rows are judged each. An empty table gives no
    rows, empty labels no steps. Other columns are left out, whatever their names.

    Texts are read once. Tallies are sums per stratum, so a hot stratum is merged where it
    is read, and steps meet the rows of a hot stratum without a shuffle.
    """
    counts = stage(measured(docs, key, stratum, text), "quality-counts")
    steps = certified_steps(counts, labels, key, quality, rules, alpha, delta)
    sizes = counts.groupBy("_stratum").agg(F.count("*").alias("_rows"))
    keyed = stage(sizes.join(steps, "_stratum", "left"), "quality-steps")

    def cutoff(rule: QualityRule) -> Column:
        return F.get(F.array(*[F.lit(c) for c in rule.cutoffs]), F.col("step"))

    failed = [
        F.when(F.expr(rule.share) > cutoff(rule), F.lit(rule.name)) for rule in rules
    ]
    return (
        join_weighted(counts, keyed, "_stratum", "_rows")
        .withColumn("base_failed", base_failed())
        .withColumn("failed_rules", F.concat_ws(",", *failed))
        .select(
            F.col("_key").alias(key),
            *COUNTS[:5],
            "base_failed",
            "failed_rules",
            (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"),
        )
    )
